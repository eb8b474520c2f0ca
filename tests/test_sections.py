"""Section extraction: parity with Python ``re`` on edge strings and on
the papers fixture, JSON shapes, content assembly, status."""

import re

import pytest
from pyspark.sql import functions as F

from quire.functions import sections as S


# Brute-force oracle: the source pipeline's rule run with Python re.
def py_first_long(content, patterns):
    for p in patterns:
        m = re.search(p, content, re.DOTALL | re.IGNORECASE)
        if m:
            t = re.sub(r"\s+", " ", m.group(1).strip())
            if len(t) > 50:
                return t
    return None


def py_sections(content):
    if content is None or not content.strip():
        return None, None
    a = py_first_long(content, S.ABSTRACT_PATTERNS)
    c = py_first_long(content, S.CONCLUSION_PATTERNS)
    if c is None:
        c = py_first_long(content, S.DISCUSSION_PATTERNS)
    return a, c


LONG = "This sentence is long enough to pass the minimum length gate easily."
EDGE = [
    f"Abstract\n{LONG}\n1 Introduction\nbody",
    f"ABSTRACT\n{LONG}\nIntroduction text",
    f"Abstract — {LONG}\n2 Methods",
    f"Abstract: {LONG} more words here\nIntroduction",
    f"abstract\r\n{LONG}\r\n1 Intro",
    f"Abstract\n{LONG} still abstract line\n1 Introduction",
    f"Abſtract\n{LONG}\n1 Intro",                       # long s folds to s
    f"Abstract\n\x1c{LONG}\x1f\n1 Introduction",       # Python-only whitespace
    f"Abstract\n{LONG}\n\n\n",                          # trailing blank lines
    f"5. Conclusions\n{LONG}\nReferences\n[1] x",
    f"CONCLUSION\n{LONG}\nACKNOWLEDGEMENTS",
    f"Conclusion and Limitations\n{LONG}\n7 Appendix",
    f"6 Discussion\n{LONG}\nReferences",
    f"Concluding Remarks\n{LONG}\n",
    f"In conclusion, {LONG}\nReferences",               # first occurrence wins (Q3)
    f"Abstract\nshort\nAbstract: {LONG}\n1 Intro",
    "",
    "   \n\t ",
    f"Discussion and Future Work\n{LONG}\nConclusion\n{LONG}",
    f"Keywords\nAbstract\n{LONG}\nKelvin sign line",
]


def test_pattern_counts():
    assert [len(S.SECTION_PATTERNS[k]) for k in ("abstract", "conclusion", "discussion")] == [3, 4, 4]


def test_regex_parity_edge_strings(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE)], "i int, content string")
    got = {r.i: (r.abstract, r.conclusion) for r in
           S.with_sections(df, status=None).collect()}
    for i, t in enumerate(EDGE):
        assert got[i] == py_sections(t), (i, t)


def test_regex_parity_papers(spark):
    from tests.conftest import SF0001
    from quire.plans import fixtures
    p = fixtures.papers(spark, SF0001).select("doc_id", "content")
    rows = S.with_sections(p, status=None).collect()
    assert len(rows) > 0
    for r in rows:
        assert (r.abstract, r.conclusion) == py_sections(r.content), r.doc_id
    assert any(r.abstract for r in rows) and any(r.conclusion for r in rows)


def test_status(spark):
    df = spark.createDataFrame([("",), (EDGE[0],), (EDGE[9],), (EDGE[0] + "\n" + EDGE[9],),
                                ("nothing here",)], "content string")
    got = [r.status for r in S.with_sections(df).collect()]
    assert got == ["no content", "no conclusion", "no abstract", "ok", "none"]


def blocks_df(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "b array<map<string,string>>")


def test_assemble_content(spark):
    rows = [
        [{"text": "  one "}, {"label": "x"}, {"text": "two\n"}],
        [{"text": "a"}, {"text": None}],
        [],
    ]
    got = [r.c for r in blocks_df(spark, rows).select(S.assemble_content("b").alias("c")).collect()]
    assert got == ["one\n\ntwo\n\n", None, ""]


@pytest.mark.parametrize("raw,expected", [
    ('{"texts": [{"text": " a "}, {"x": 1}, {"text": "b"}]}', "a\n\nb\n\n"),
    ('"just a string with texts inside"', "just a string with texts inside"),
    ('{"text": "root text"}', "root text"),
    ('{"texts": [], "text": "hidden"}', ""),            # Q5: empty list hides root text
    ('{"texts": [{"text": null}]}', None),              # Q4: null text breaks the document
    ('{"other": 1}', ""),
    ('not json', None),
    ('[1, 2]', ""),
])
def test_parsed_document_shapes(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "raw string")
    got = df.select(S.parsed_document_content("raw").alias("c")).first().c
    assert got == expected
