"""Scalar text functions as Spark Columns (all JVM-side, codegen-friendly).

Whitespace follows Python's ``str.isspace``: Java's Unicode ``\\s`` class
plus the four separators U+001C..U+001F, which Python counts as space and
Java does not.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's whitespace as a Java character class (with the (?U) flag).
WS = r"[\s\x1c-\x1f]"

_STRIP = rf"(?U)^{WS}+|{WS}+\z"
_WS_RUN = rf"(?U){WS}+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """``str.strip()``: drop leading and trailing whitespace."""
    return F.regexp_replace(_col(c), _STRIP, "")


def clean_span(c) -> Column:
    """Strip, then turn every whitespace run into one space.

    Collapsing first leaves at most one plain space at either end, which
    ``trim`` (spaces only) removes: one regex pass instead of two.
    """
    return F.trim(F.regexp_replace(_col(c), _WS_RUN, " "))


_NON_WS = rf"(?U)[^{WS[1:-1]}]"


def is_blank(c) -> Column:
    """NULL or only whitespace (Python truthiness of ``s.strip()``). A search
    for the first non-space character: stops at once on ordinary text."""
    c = _col(c)
    return c.isNull() | ~c.rlike(_NON_WS)


def min_length(c, n: int = 50) -> Column:
    """The value if it is strictly longer than ``n`` characters, else NULL."""
    c = _col(c)
    return F.when(F.length(c) > n, c)


def default_text(c, default: str = "") -> Column:
    """NULL or '' become ``default``."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def preview(c, n: int = 100) -> Column:
    """First ``n`` characters plus '...' when longer."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))) \
            .otherwise(c)


def head_lines(c, n: int = 5) -> Column:
    """The first ``n`` lines, joined by newlines (C8, content preview)."""
    return F.array_join(F.slice(F.split(_col(c), "\n"), 1, n), "\n")


# The five predefined XML entities and their characters.
XML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"),
                ("&amp;", "&")]


def _code_point(digits) -> Column:
    """The character of a code point (a number)."""
    return F.decode(F.unhex(F.lpad(F.hex(digits), 8, "0")), "UTF-32")


def decode_xml_entities(c) -> Column:
    """The five named entities and numeric ones (``&#201;``, ``&#xC9;``)."""
    out = _col(c)
    numeric = F.array_distinct(F.regexp_extract_all(out, F.lit(r"&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});"), 0))

    def put(text, ent):
        code = F.regexp_extract(ent, r"&#x?(.*);", 1)
        value = F.when(ent.startswith("&#x"), F.conv(code, 16, 10)).otherwise(code).cast("long")
        return F.when(value.between(1, 0x10FFFF), F.replace(text, ent, _code_point(value))).otherwise(text)
    out = F.aggregate(numeric, out, put)
    for ent, ch in XML_ENTITIES:  # '&amp;' last so '&amp;lt;' stays '&lt;'
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


#: Text content: characters that open no tag, and CDATA sections.
CONTENT = r"(?:[^<]++|<!\[CDATA\[.*?\]\]>)++"


def decoded_content(c) -> Column:
    """Element text: CDATA sections stand for themselves, entities outside of
    them are decoded. (A text that has CDATA sections is taken without decoding
    when it is nothing else.)"""
    c = _col(c)
    marks = r"(?s)<!\[CDATA\[(.*?)\]\]>"
    bare = F.regexp_replace(c, marks, "")
    return F.when(~c.contains("<![CDATA["), decode_xml_entities(c)) \
            .when(strip(bare) == "", F.regexp_replace(c, marks, "$1")) \
            .otherwise(F.concat(decode_xml_entities(F.regexp_extract(c, r"(?s)^(.*?)<!\[CDATA\[", 1)),
                                F.regexp_replace(F.regexp_replace(c, r"(?s)^.*?(?=<!\[CDATA\[)", ""), marks, "$1")))


def tag_pattern(tags: list[str]) -> str:
    """Regex for an element whose text is what BeautifulSoup's ``tag.string``
    reads: its only child is text, or its only child is an element whose
    ``.string`` is text (``<a><b>x</b></a>`` gives 'x'). Groups: 1 the
    opening tags of the nested chain, 2 the text, 3 the closing tags; a
    match counts only when the chain's openers and closers pair up
    (``_paired``). XML names are case-sensitive, so no (?i)."""
    names = "|".join(re.escape(t) for t in tags)
    return (rf"(?s)<(?:{names})(?:\s[^>]*)?>((?:<[^/!?>][^>]*>)*)({CONTENT})((?:</[^>]+>)*)"
            rf"</(?:{names})>")


def _paired(opens, closes) -> Column:
    return F.size(F.split(opens, "<")) == F.size(F.split(closes, "<"))


def tag_texts(c, tags: list[str]) -> Column:
    """``.string`` of every element named in ``tags`` that has one,
    entity-decoded and stripped, in document order (an array; empty if
    none)."""
    pat = F.lit(tag_pattern(tags))
    found = F.arrays_zip(F.regexp_extract_all(_col(c), pat, 1).alias("o"),
                         F.regexp_extract_all(_col(c), pat, 2).alias("t"),
                         F.regexp_extract_all(_col(c), pat, 3).alias("c"))
    kept = F.filter(found, lambda z: _paired(z["o"], z["c"]))
    return F.transform(kept, lambda z: strip(decoded_content(z["t"])))


def first_tag_text(c, tag: str) -> Column:
    """``.string`` of the first ``tag`` element, or NULL when it has none.
    The atomic group pins the match to the first opening tag."""
    name = re.escape(tag)
    pat = (rf"(?s)^(?>.*?<{name}(?:\s[^>]*)?>)((?:<[^/!?>][^>]*>)*)({CONTENT})((?:</[^>]+>)*)"
           rf"</{name}>")
    col = _col(c)
    opens, text, closes = (F.regexp_extract(col, pat, i) for i in (1, 2, 3))
    # decoded in a lambda, so that the scan for the text is evaluated once
    decoded = F.get(F.transform(F.array(text), lambda x: strip(decoded_content(x))), 0)
    return F.when((text != "") & _paired(opens, closes), decoded)
