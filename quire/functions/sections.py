"""Section extraction from paper text: abstract, conclusion, discussion.

Each section has an ordered list of patterns. The first pattern whose
first match, cleaned (strip + collapse whitespace), is longer than 50
characters wins; the discussion stands in for a missing conclusion.

All of it is Column expressions: the cascade is a ``coalesce`` of gated
``regexp_extract`` calls, so later patterns only run when earlier ones
gave nothing, and the whole thing stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import WS, clean_span, is_blank, strip, min_length

# ---------------------------------------------------------------------------
# The section patterns, in the source pipeline's own (Python
# ``re``) syntax and order. They are matched with DOTALL and IGNORECASE.
ABSTRACT_PATTERNS = [
    r'Abstract\s*\n(.*?)(?=\n\s*\d|\n\s*[A-Z][a-z]|\Z)',
    r'ABSTRACT\s*\n(.*?)(?=\n\s*\d|\n\s*[A-Z][a-z]|\Z)',
    r'Abstract\s*[-–—]\s*(.*?)(?=\n\s*\d|\n\s*[A-Z][a-z]|\Z)',
    r'ABSTRACT\s*[-–—]\s*(.*?)(?=\n\s*\d|\n\s*[A-Z][a-z]|\Z)',
    r'Abstract[:\.]?\s*(.*?)(?=\n\s*(?:\d+\.?\s*[A-Z]|Introduction|INTRODUCTION)|\Z)',
    r'ABSTRACT[:\.]?\s*(.*?)(?=\n\s*(?:\d+\.?\s*[A-Z]|Introduction|INTRODUCTION)|\Z)',
]
CONCLUSION_PATTERNS = [
    r'(?:\d+\.?\s*)?Conclusion[s]?\s*\n(.*?)(?=\n\s*(?:Acknowledgement|ACKNOWLEDGEMENT|Reference|REFERENCE|\d+\.?\s*[A-Z])|\Z)',
    r'(?:\d+\.?\s*)?CONCLUSION[S]?\s*\n(.*?)(?=\n\s*(?:Acknowledgement|ACKNOWLEDGEMENT|Reference|REFERENCE|\d+\.?\s*[A-Z])|\Z)',
    r'Conclusion and Limitations\s*\n(.*?)(?=\n\s*(?:Acknowledgement|ACKNOWLEDGEMENT|Reference|REFERENCE|\d+\.?\s*[A-Z])|\Z)',
    r'(?:\d+\.?\s*)?Conclusion[s]?[:\.]?\s*(.*?)(?=\n\s*(?:Acknowledgement|Reference|\d+\.?\s*[A-Z])|\Z)',
    r'(?:\d+\.?\s*)?CONCLUSION[S]?[:\.]?\s*(.*?)(?=\n\s*(?:Acknowledgement|Reference|\d+\.?\s*[A-Z])|\Z)',
    r'Concluding Remarks\s*\n(.*?)(?=\n\s*(?:Acknowledgement|Reference|\d+\.?\s*[A-Z])|\Z)',
]
DISCUSSION_PATTERNS = [
    r'(?:\d+\.?\s*)?Discussion\s*\n(.*?)(?=\n\s*(?:Conclusion|CONCLUSION|Acknowledgement|ACKNOWLEDGEMENT|Reference|REFERENCE|\d+\.?\s*[A-Z])|\Z)',
    r'(?:\d+\.?\s*)?DISCUSSION\s*\n(.*?)(?=\n\s*(?:Conclusion|CONCLUSION|Acknowledgement|ACKNOWLEDGEMENT|Reference|REFERENCE|\d+\.?\s*[A-Z])|\Z)',
    r'Discussion and Future Work\s*\n(.*?)(?=\n\s*(?:Conclusion|CONCLUSION|Acknowledgement|ACKNOWLEDGEMENT|Reference|REFERENCE|\d+\.?\s*[A-Z])|\Z)',
    r'(?:\d+\.?\s*)?Discussion[:\.]?\s*(.*?)(?=\n\s*(?:Conclusion|Acknowledgement|Reference|\d+\.?\s*[A-Z])|\Z)',
    r'Discussion and Analysis\s*\n(.*?)(?=\n\s*(?:Conclusion|Acknowledgement|Reference|\d+\.?\s*[A-Z])|\Z)',
]
# Minimum cleaned length: a span counts only when strictly longer.
MIN_SECTION_CHARS = 50
# ---------------------------------------------------------------------------


def distinct_patterns(patterns: list[str]) -> list[str]:
    """Drop patterns that repeat an earlier one under IGNORECASE (the
    upper-case twins); a repeat can never win where its twin lost."""
    seen, out = set(), []
    for p in patterns:
        if p.lower() not in seen:
            seen.add(p.lower())
            out.append(p)
    return out


def to_java(pattern: str) -> str:
    """Python ``re`` (str, DOTALL|IGNORECASE) → java.util.regex, same matches.

    ``\\Z`` is Python's end of text, Java's ``\\z``. ``u`` + ``U`` give
    Unicode case folding and Unicode ``\\s``/``\\d`` as Python has; ``\\s``
    is widened by U+001C..U+001F, which Python counts as space.
    """
    return "(?isuU)" + pattern.replace(r"\Z", r"\z").replace(r"\s", WS)


def to_re2(pattern: str) -> str:
    """The same pattern for RE2 (DuckDB, used by the SQL oracle). RE2 has
    no lookahead; every lookahead here is last and only group 1 is read, so
    a plain group gives the same group 1."""
    return "(?is)" + pattern.replace("(?=", "(?:").replace(r"\Z", r"\z")


_OPTIONAL_NUMBER = r"(?:\d+\.?\s*)?"


def search_form(pattern: str) -> str:
    """Drop an optional section number in front of a heading that starts
    with a letter. It can only move the match start back over digits, dots
    and spaces before the same heading occurrence; which heading is found
    and group 1 stay the same. Without it every text position is cheaper
    to try (about 2x on the conclusion and discussion lists). The SQL
    oracle keeps the verbatim patterns, so the check covers this rule."""
    rest = pattern[len(_OPTIONAL_NUMBER):]
    if pattern.startswith(_OPTIONAL_NUMBER) and rest[:1].isalpha():
        return rest
    return pattern


SECTION_PATTERNS = {
    "abstract": distinct_patterns(ABSTRACT_PATTERNS),
    "conclusion": distinct_patterns(CONCLUSION_PATTERNS),
    "discussion": distinct_patterns(DISCUSSION_PATTERNS),
}


def first_long_match(content, patterns: list[str],
                     min_chars: int = MIN_SECTION_CHARS) -> Column:
    """Cleaned group 1 of the first pattern whose first match is longer than
    ``min_chars``; NULL when none is (C3/C4/C5 with C2 and C6)."""
    c = F.col(content) if isinstance(content, str) else content
    spans = []
    for p in patterns:
        span = clean_span(F.regexp_extract(c, to_java(search_form(p)), 1))
        # tested in a lambda, so that a pattern is searched once
        spans.append(F.get(F.transform(F.array(span), lambda s: min_length(s, min_chars)), 0))
    return F.coalesce(*spans)


def extract_abstract(content) -> Column:
    return first_long_match(content, SECTION_PATTERNS["abstract"])


def extract_discussion(content) -> Column:
    return first_long_match(content, SECTION_PATTERNS["discussion"])


def extract_conclusion(content, with_discussion: bool = True) -> Column:
    """Conclusion; when none is found and ``with_discussion``, the
    discussion stands in for it (C4 + C5)."""
    pats = SECTION_PATTERNS["conclusion"]
    if with_discussion:
        pats = pats + SECTION_PATTERNS["discussion"]
    return first_long_match(content, pats)


def section_status(content, abstract, conclusion) -> Column:
    """ok / no abstract / no conclusion / none / no content."""
    a = F.col(abstract) if isinstance(abstract, str) else abstract
    k = F.col(conclusion) if isinstance(conclusion, str) else conclusion
    return (F.when(is_blank(content), F.lit("no content"))
             .when(a.isNull() & k.isNull(), F.lit("none"))
             .when(a.isNull(), F.lit("no abstract"))
             .when(k.isNull(), F.lit("no conclusion"))
             .otherwise(F.lit("ok")))


def assemble_content(blocks) -> Column:
    """Text blocks → one string (C1): each block that has a ``text`` key,
    stripped and followed by a blank line. A block whose text is JSON null
    makes the whole document unreadable (NULL), as it fails the source
    pipeline's ``strip``."""
    b = F.col(blocks) if isinstance(blocks, str) else blocks
    with_text = F.filter(b, lambda m: F.map_contains_key(m, "text"))
    joined = F.array_join(
        F.transform(with_text, lambda m: F.concat(strip(m["text"]), F.lit("\n\n"))), "")
    broken = F.exists(with_text, lambda m: m["text"].isNull())
    return F.when(~broken, joined)


def assemble_text_blocks(blocks) -> Column:
    """C1 for a plain ``array<string>`` of block texts: each stripped and
    followed by a blank line; a NULL block makes the document NULL."""
    b = F.col(blocks) if isinstance(blocks, str) else blocks
    joined = F.array_join(F.transform(b, lambda t: F.concat(strip(t), F.lit("\n\n"))), "")
    return F.when(~F.exists(b, lambda t: t.isNull()), joined)


def _is_text_string(x) -> Column:
    return (F.schema_of_variant(x) == "STRING") & (F.try_variant_get(x, "$", "string") == "text")


def _assemble_variant_blocks(texts) -> Column:
    """C1 over the raw ``texts`` value, with each element's JSON type tested
    as the source pipeline's loop would meet it: an object with a string
    ``text`` is kept (stripped); an object without ``text`` is skipped; an
    object whose ``text`` is not a string (null, number, ..) breaks the
    document. A non-object element is skipped unless the ``'text' in el``
    test succeeds on it (a string containing "text", a list holding "text")
    or fails (number, boolean, null), both of which break the document.
    A ``texts`` that is a string yields ''; an object is walked by its keys;
    anything else breaks the document (NULL)."""
    ttype = F.schema_of_variant(texts)
    elems = F.try_variant_get(texts, "$", "array<variant>")

    def text_of(e):
        return F.try_variant_get(e, "$.text", "variant")

    def kept(e):
        return (F.schema_of_variant(e).startswith("OBJECT") & text_of(e).isNotNull()
                & (F.schema_of_variant(text_of(e)) == "STRING"))

    def breaks(e):
        k = F.schema_of_variant(e)
        obj_bad = (k.startswith("OBJECT") & text_of(e).isNotNull()
                   & (F.schema_of_variant(text_of(e)) != "STRING"))
        str_bad = (k == "STRING") & F.try_variant_get(e, "$", "string").contains("text")
        arr_bad = k.startswith("ARRAY") & F.exists(
            F.try_variant_get(e, "$", "array<variant>"), _is_text_string)
        other_bad = ~(k.startswith("OBJECT") | (k == "STRING") | k.startswith("ARRAY"))
        return obj_bad | str_bad | arr_bad | other_bad

    joined = F.array_join(F.transform(
        F.filter(elems, kept),
        lambda e: F.concat(strip(F.try_variant_get(e, "$.text", "string")), F.lit("\n\n"))), "")
    keys = F.map_keys(F.try_variant_get(texts, "$", "map<string,variant>"))
    return (F.when(ttype.startswith("ARRAY"), F.when(~F.exists(elems, breaks), joined))
             .when(ttype == "STRING", F.lit(""))
             .when(ttype.startswith("OBJECT"),
                   F.when(~F.exists(keys, lambda k: k.contains("text")), F.lit(""))))


def parsed_document_content(raw_json) -> Column:
    """Content of one parsed-document JSON text, for its three shapes:
    ``{"texts": [{"text": ..}, ..]}``, a bare JSON string, or
    ``{"text": ..}``. The type is tested first, so a bare string that
    happens to contain "texts" is read as text. Unparseable JSON, a broken
    block list, a non-string root text, or a document the source pipeline
    could not read (number, boolean, null, a list holding "texts") gives
    NULL; anything else without content gives ''.
    """
    raw = F.col(raw_json) if isinstance(raw_json, str) else raw_json
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    texts = F.try_variant_get(v, "$.texts", "variant")
    root_text = F.try_variant_get(v, "$.text", "variant")
    list_with_texts = kind.startswith("ARRAY") & F.exists(
        F.try_variant_get(v, "$", "array<variant>"),
        lambda x: (F.schema_of_variant(x) == "STRING")
        & (F.try_variant_get(x, "$", "string") == "texts"))
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(kind == "STRING", F.try_variant_get(v, "$", "string"))
             .when(kind.startswith("ARRAY"), F.when(~list_with_texts, F.lit("")))
             .when(~kind.startswith("OBJECT"), F.lit(None).cast("string"))
             .when(texts.isNotNull(), _assemble_variant_blocks(texts))
             .when(root_text.isNotNull(),
                   F.when(F.schema_of_variant(root_text) == "STRING",
                          F.try_variant_get(v, "$.text", "string")))
             .otherwise(F.lit("")))


def with_sections(df, content: str = "content", abstract: str = "abstract",
                  conclusion: str = "conclusion", status: str | None = "status"):
    """Add abstract, conclusion (discussion as fallback) and status columns.

    Sections of a blank content are NULL, as the source pipeline stops
    there. Narrow transformation: no shuffle, one pass per row.
    """
    blank = is_blank(content)
    out = (df.withColumn(abstract, F.when(~blank, extract_abstract(content)))
             .withColumn(conclusion, F.when(~blank, extract_conclusion(content))))
    if status:
        out = out.withColumn(status, section_status(content, abstract, conclusion))
    return out
