"""Column functions: verdicts, affiliations, search, prompts, text helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quire.functions import prompts as P
from quire.functions import search as Q
from quire.functions import text as T
from quire.functions.affiliation import affiliations
from quire.functions.verdict import parse_verdict


def one(spark, col_fn, value, ddl="v string"):
    df = spark.createDataFrame([(value,)], ddl)
    return df.select(col_fn(F.col("v")).alias("o")).first().o


VERDICTS = [
    ('{"is_prestigious": true, "reason": "top lab"}', "yes"),
    ('{"is_prestigious": false, "reason": "x"}', "no"),
    ('{"is_prestigious": "yes", "reason": "x"}', "yes"),
    ('{"is_prestigious": "True", "reason": "x"}', "yes"),
    ('{"is_prestigious": "on", "reason": "x"}', "yes"),
    ('{"is_prestigious": "no", "reason": "x"}', "no"),
    ('{"is_prestigious": "maybe", "reason": "x"}', "no"),
    ('{"is_prestigious": 1, "reason": ""}', "yes"),
    ('{"is_prestigious": 0, "reason": ""}', "no"),
    ('{"is_prestigious": 2, "reason": ""}', "no"),
    ('{"is_prestigious": true}', "no"),                      # reason required
    ('{"reason": "x"}', "no"),                               # flag required
    ('{"is_prestigious": true, "reason": 5}', "no"),         # reason must be text
    ('{"is_prestigious": null, "reason": "x"}', "no"),
    ('{"is_prestigious": true, "reason": "x", "extra": 1}', "yes"),
    ('  {"is_prestigious": true, "reason": "x"}\n', "yes"),
    ('I think so', "no"),
    ('[true, "x"]', "no"),
    ('{"is_prestigious": true, "reason": "x"} trailing', "no"),
    ('', "no"),
    (None, "no"),
]


@pytest.mark.parametrize("text,expected", VERDICTS)
def test_parse_verdict(spark, text, expected):
    assert one(spark, parse_verdict, text) == expected


AFF = [
    ('<entry><arxiv:affiliation> MIT </arxiv:affiliation><affiliation>MIT</affiliation></entry>', "MIT"),
    ('<entry><affiliation>B &amp; C Labs</affiliation><affiliation>A Univ</affiliation></entry>',
     "A Univ; B & C Labs"),
    ('<entry><affiliation>X</affiliation><arxiv:comment>Work done at Example Institute</arxiv:comment></entry>',
     "Work done at Example Institute; X"),
    ('<entry><arxiv:comment>12 pages, 3 figures</arxiv:comment></entry>', None),
    ('<entry><affiliation><b>nested</b></affiliation></entry>', "nested"),  # one child: read through
    ('<entry><affiliation><b>x</b><i>y</i></affiliation></entry>', None),   # two children
    ('<entry><affiliation>a <b>x</b></affiliation></entry>', None),         # text + element
    ('<entry><affiliation><br/>x</affiliation></entry>', None),             # empty element + text
    ('<entry></entry>', None),
    ('<entry><affiliation>Broken', None),                                   # malformed: no crash
    ('<entry><arxiv:comment><i>x</i> y</arxiv:comment><arxiv:comment>Big Company</arxiv:comment></entry>',
     None),                                                                 # only the first comment counts
    ('<entry><arxiv:comment><i>Some University</i></arxiv:comment></entry>', "Some University"),
]


@pytest.mark.parametrize("xml,expected", AFF)
def test_affiliations(spark, xml, expected):
    assert one(spark, affiliations, xml) == expected


def test_strip_version(spark):
    assert one(spark, Q.strip_version, "2401.00001v3") == "2401.00001"
    assert one(spark, Q.strip_version, "solv-int/9901001v1") == "solv-int/9901001"
    assert one(spark, lambda c: Q.strip_version(c, strict_reference=True),
               "solv-int/9901001v1") == "sol"


def found(spark, *expressions):
    df = spark.createDataFrame([(1, "A World Model paper", None), (2, "x", "about video diffusion"),
                                (3, "World model", "video"), (4, None, "world")],
                               "n int, title string, content string")
    return [r.n for r in df.filter(Q.keyword_predicate(["title", "content"], list(expressions))).collect()]


def test_search_expressions(spark):
    assert found(spark, '"World Model" OR "diffusion"') == [1, 2, 3]
    assert found(spark, '"world model" AND "video"') == [3]
    assert found(spark, '"world" ANDNOT ("video" OR "paper")') == [4]
    assert found(spark, 'ti:paper OR (abs:"video" AND "diffusion")') == [1, 2]
    assert found(spark, "video diffusion") == [2]          # words side by side are a phrase
    assert found(spark) == found(spark, " ") == []
    for bad in ('("a"', '"a" AND', 'au:lee', '"a" "b"', 'OR "a"', '"a'):
        with pytest.raises(ValueError):
            found(spark, bad)


def test_author_string_takes_structs(spark):
    df = spark.createDataFrame([([("A", 1), ("B", 2)],)], "v array<struct<name:string,n:int>>")
    assert df.select(Q.author_string("v", df)).first()[0] == "A, B"


def test_tag_text_reads_cdata_and_numeric_entities(spark):
    from quire.functions.text import tag_texts
    xml = ("<affiliation><![CDATA[MIT <Lab> &amp;]]></affiliation><affiliation>&#201;cole &#xC9; &amp;#201;"
           "</affiliation><affiliation>a &lt; <![CDATA[b]]></affiliation>")
    df = spark.createDataFrame([(xml,)], "x string")
    assert df.select(tag_texts("x", ["affiliation"])).first()[0] == [
        "MIT <Lab> &amp;", "\u00c9cole \u00c9 &#201;", "a < b"]


def test_keyword_predicate(spark):
    df = spark.createDataFrame([("A World Model paper", None), ("x", "about diffusion"), ("x", "y")],
                               "title string, content string")
    got = [r.title for r in df.filter(Q.keyword_predicate(["title", "content"],
                                                      ['"world model"', '"Diffusion"'])).collect()]
    assert got == ["A World Model paper", "x"]


def test_date_range(spark):
    rows = [(dt.datetime(2024, 1, 12, 23, 59),), (dt.datetime(2024, 1, 13, 0, 0),),
            (dt.datetime(2024, 1, 20, 23, 59),), (dt.datetime(2024, 1, 21, 0, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = df.filter(Q.date_range_predicate("ts", "lastWeek", "today", "2024-01-20")).count()
    assert got == 2


def test_summary_prompt_text(spark):
    df = spark.createDataFrame([(" A. ", "C."), ("A.", None), ("", "C."), (None, " ")],
                               "a string, c string")
    got = [r.p for r in df.select(P.summary_prompt("a", "c").alias("p")).collect()]
    ask = "Please provide a clear and concise summary of the key findings and implications."
    assert got[0] == ("Here is the abstract and conclusion from a research paper:\n\n"
                      "Abstract:\nA.\n\nConclusion:\nC.\n\n" + ask)
    assert got[1] == "Here is the abstract from a research paper:\n\nAbstract:\nA.\n\n" + ask
    assert got[2] == "Here is the conclusion from a research paper:\n\nConclusion:\nC.\n\n" + ask
    assert got[3] is None


def test_flag_missing(spark):
    df = spark.createDataFrame([("S", "a", "c"), ("S", "", "c"), ("S", "a", None),
                                ("S", None, " "), (None, "a", "c")], "s string, a string, c string")
    got = [r.f for r in df.select(P.flag_missing("s", "a", "c").alias("f")).collect()]
    assert got == ["S", "(missing abstract) S", "(missing conclusion) S", None, None]


def test_relevance_prompt(spark):
    df = spark.createDataFrame([("T", None, "", "Abs")],
                               "t string, au string, af string, ab string")
    got = df.select(P.relevance_prompt("t", "au", "af", "ab").alias("p")).first().p
    assert got == ("Paper Information:\nTitle: T\nAuthors: None\nAffiliation: Not provided\n"
                   "Abstract: Abs\n\nAnalyze the affiliation information and determine if "
                   "this is from a prestigious institution.")


def test_text_helpers(spark):
    assert one(spark, T.clean_span, "  a \n\t b  ") == "a b"
    assert one(spark, T.strip, "\x1c x \x1f") == "x"
    assert one(spark, T.is_blank, " 　\n") is True
    assert one(spark, T.is_blank, " x ") is False
    assert one(spark, lambda c: T.preview(c, 5), "abcdefgh") == "abcde..."
    assert one(spark, lambda c: T.preview(c, 5), "abc") == "abc"
    assert one(spark, lambda c: T.head_lines(c, 2), "1\n2\n3") == "1\n2"
    assert one(spark, lambda c: T.default_text(c, "d"), "") == "d"
    assert one(spark, lambda c: T.default_text(c, "d"), None) == "d"
    assert one(spark, T.decode_xml_entities, "a &amp;lt; &quot;b&quot;") == 'a &lt; "b"'


def test_small_public_helpers(spark):
    from quire.functions.sections import extract_discussion
    assert one(spark, lambda c: T.min_length(c, 3), "abcd") == "abcd"
    assert one(spark, lambda c: T.min_length(c, 3), "abc") is None
    assert one(spark, lambda c: Q.has_any_author_in_string(c, ["B C"]), "A, B C") is True
    assert one(spark, Q.author_struct_string, [("A",), ("B",)], "v array<struct<name:string>>") == "A, B"
    long = "This sentence is long enough to pass the minimum length gate easily."
    assert one(spark, extract_discussion, f"Discussion\n{long}\nReferences") == long
