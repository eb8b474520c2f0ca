"""Prompt texts and summary flags as Column expressions (H1, H2, H4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import default_text, is_blank, strip


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# The prompt texts, in the order they appear in each prompt.
# Summary prompt: head, which sections, source line, labelled sections, ask.
SUMMARY_HEAD = "Here is "
SUMMARY_BOTH = "the abstract and conclusion"
SUMMARY_ABSTRACT = "the abstract"
SUMMARY_CONCLUSION = "the conclusion"
SUMMARY_FROM = " from a research paper:\n\n"
ABSTRACT_LABEL = "Abstract:\n"
CONCLUSION_LABEL = "Conclusion:\n"
SECTION_END = "\n\n"
SUMMARY_ASK = "Please provide a clear and concise summary of the key findings and implications."
# Flags put in front of a generated summary.
MISSING_ABSTRACT = "(missing abstract)"
MISSING_CONCLUSION = "(missing conclusion)"
# Relevance prompt: four labelled lines, a blank line, the ask.
RELEVANCE_HEAD = "Paper Information:\nTitle: "
RELEVANCE_AUTHORS = "\nAuthors: "
RELEVANCE_AFFILIATION = "\nAffiliation: "
RELEVANCE_ABSTRACT = "\nAbstract: "
RELEVANCE_ASK = ("\n\nAnalyze the affiliation information and determine if this is from a "
                 "prestigious institution.")
NOT_PROVIDED = "Not provided"
MISSING_VALUE = "None"
# ---------------------------------------------------------------------------


def summary_prompt(abstract, conclusion) -> Column:
    """Prompt from whichever sections are present (non-blank, stripped);
    NULL when neither is (such a paper is not summarised)."""
    a, k = strip(_col(abstract)), strip(_col(conclusion))
    has_a, has_k = ~is_blank(abstract), ~is_blank(conclusion)
    which = (F.when(has_a & has_k, F.lit(SUMMARY_BOTH))
              .when(has_a, F.lit(SUMMARY_ABSTRACT))
              .otherwise(F.lit(SUMMARY_CONCLUSION)))
    body = F.concat(
        F.lit(SUMMARY_HEAD), which, F.lit(SUMMARY_FROM),
        F.when(has_a, F.concat(F.lit(ABSTRACT_LABEL), a, F.lit(SECTION_END))).otherwise(F.lit("")),
        F.when(has_k, F.concat(F.lit(CONCLUSION_LABEL), k, F.lit(SECTION_END))).otherwise(F.lit("")),
        F.lit(SUMMARY_ASK))
    return F.when(has_a | has_k, body)


def summarisable(abstract, conclusion) -> Column:
    """At least one section is non-blank."""
    return ~is_blank(abstract) | ~is_blank(conclusion)


def flag_missing(summary, abstract, conclusion) -> Column:
    """Prefix the generated summary with the missing-section flags; NULL when
    the summary is NULL or both sections are missing (H2)."""
    return flag_missing_flags(summary, is_blank(abstract), is_blank(conclusion))


def flag_missing_flags(summary, no_abstract, no_conclusion) -> Column:
    """``flag_missing`` from precomputed "section is blank" booleans."""
    s = _col(summary)
    miss_a, miss_k = _col(no_abstract), _col(no_conclusion)
    flags = F.concat_ws(" ", F.when(miss_a, F.lit(MISSING_ABSTRACT)),
                        F.when(miss_k, F.lit(MISSING_CONCLUSION)))
    return (F.when(s.isNull() | (miss_a & miss_k), F.lit(None).cast("string"))
             .when(miss_a | miss_k, F.concat(flags, F.lit(" "), s))
             .otherwise(s))


def _or_none(c) -> Column:
    # Python's f-string renders a missing value as 'None'.
    return F.coalesce(_col(c), F.lit(MISSING_VALUE))


def relevance_prompt(title, authors, affiliation, abstract) -> Column:
    """Relevance prompt (H4). A missing affiliation reads 'Not provided';
    other missing fields read 'None'."""
    return F.concat(
        F.lit(RELEVANCE_HEAD), _or_none(title),
        F.lit(RELEVANCE_AUTHORS), _or_none(authors),
        F.lit(RELEVANCE_AFFILIATION), default_text(affiliation, NOT_PROVIDED),
        F.lit(RELEVANCE_ABSTRACT), _or_none(abstract),
        F.lit(RELEVANCE_ASK))
