"""Property test: the Spark verdict rule agrees with pydantic validation of
a required bool + required str model on generated model answers (unique
keys; duplicate keys are the known, kept difference)."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

pydantic = pytest.importorskip("pydantic")

from quire.functions.verdict import parse_verdict  # noqa: E402


class Verdict(pydantic.BaseModel):
    is_prestigious: bool
    reason: str


def expected(text):
    try:
        return "yes" if Verdict.model_validate_json(text).is_prestigious else "no"
    except Exception:
        return "no"


VALUES = [True, False, None, 0, 1, 2, -1, 0.0, 1.0, 1.5, "yes", "no", "Yes", "TRUE", "true",
          "false", "on", "off", "t", "f", "y", "n", "1", "0", "maybe", "", " yes", [], [True], {},
          {"a": 1}, "q", "reason text", 5]
KEYS = ["is_prestigious", "reason", "extra", "Is_prestigious"]
SPACES = ["", " ", "\n", "\t", "  \n "]

objects = st.dictionaries(st.sampled_from(KEYS), st.sampled_from(VALUES), max_size=4)
answers = st.one_of(
    st.tuples(st.sampled_from(SPACES), objects, st.sampled_from(SPACES),
              st.sampled_from(["", "", "", " junk", "}"])).map(
        lambda t: t[0] + json.dumps(t[1]) + t[2] + t[3]),
    st.sampled_from(["I think so", "", "null", "[]", "true", '"yes"', "{", "{}"]),
)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(answers, min_size=200, max_size=200))
def test_verdict_matches_pydantic(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", parse_verdict("t").alias("v")).collect()}
    for i, t in enumerate(batch):
        assert got[i] == expected(t), repr(t)
