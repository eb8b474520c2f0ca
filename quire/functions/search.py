"""Search predicates and id/author helpers."""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The field prefixes of search expressions that are understood.
FIELDS = ("ti", "abs", "all")
_TOKEN = re.compile(r'\s*(?:([()])|(?:([A-Za-z_]+):)?(?:"([^"]*)"|([^\s()":]+)))')


def _tokens(expr: str) -> list[tuple[str, str, str]]:
    """(kind, field, text) of a search expression; a few configured words."""
    out, at = [], 0
    while expr[at:].strip():
        m = _TOKEN.match(expr, at)
        if not m:
            raise ValueError(f"search expression not understood at {expr[at:]!r}")
        at = m.end()
        bracket, field, phrase, word = m.groups()
        if bracket:
            out.append((bracket, "", bracket))
        elif word in ("AND", "OR", "ANDNOT") and not field:
            out.append((word, "", word))
        else:
            if field and field not in FIELDS:
                raise ValueError(f"search field {field!r} is not supported in {expr!r}")
            text = phrase if phrase is not None else word
            if out and phrase is None and out[-1][0] == "bare" and not field:
                out[-1] = ("bare", out[-1][1], f"{out[-1][2]} {text}")   # words side by side: a phrase
            else:
                out.append(("phrase" if phrase is not None else "bare", field or "all", text))
    return out


def expression_predicate(expr: str, test) -> Column | None:
    """The Column of one search expression: phrases joined by OR, AND, ANDNOT
    and brackets (AND and ANDNOT bind tighter). ``test(field, phrase)`` gives a
    phrase's Column. Anything else raises. None for an empty expression."""
    tokens = _tokens(expr)

    def either():
        left = both()
        while tokens and tokens[0][0] == "OR":
            tokens.pop(0)
            left = left | both()
        return left

    def both():
        left = one()
        while tokens and tokens[0][0] in ("AND", "ANDNOT"):
            without = tokens.pop(0)[0] == "ANDNOT"
            right = one()
            left = left & (~right if without else right)
        return left

    def one():
        kind, field, text = tokens.pop(0) if tokens else ("end", "", "")
        if kind == "(":
            inner = either()
            if not tokens or tokens.pop(0)[0] != ")":
                raise ValueError(f"bracket not closed in {expr!r}")
            return inner
        if kind not in ("phrase", "bare") or not text.strip():
            raise ValueError(f"search expression not understood: {expr!r}")
        return test(field, text.strip().lower())

    if not tokens:
        return None
    out = either()
    if tokens:
        raise ValueError(f"search expression not understood: {expr!r}")
    return out


def keyword_predicate(cols: list, expressions: list[str]) -> Column:
    """True when any expression holds: a phrase occurs, case-insensitively, in
    any of ``cols``; with ``ti:`` only in the first, with ``abs:`` in the others."""
    lowered = [F.lower(_col(c)) for c in cols]
    where = {"all": lowered, "ti": lowered[:1], "abs": lowered[1:]}

    def test(field, phrase):
        hits = [F.coalesce(c.contains(phrase), F.lit(False)) for c in where[field]]
        return reduce(lambda a, b: a | b, hits, F.lit(False))
    found = [p for p in (expression_predicate(e, test) for e in expressions) if p is not None]
    return reduce(lambda a, b: a | b, found, F.lit(False))


# Symbolic dates of the query config, as days back from the as-of date.
SYMBOLIC_DAYS = {"today": 0, "yesterday": 1, "lastWeek": 7, "lastMonth": 30, "lastYear": 365}


def resolve_date(symbol: str, as_of: dt.date) -> dt.date:
    if symbol in SYMBOLIC_DAYS:
        return as_of - dt.timedelta(days=SYMBOLIC_DAYS[symbol])
    return dt.date.fromisoformat(symbol)


def date_range_predicate(c, date_from: str, date_to: str, as_of) -> Column:
    """``c`` (date or timestamp) falls on a day from ``date_from`` to
    ``date_to``, both inclusive; symbols are resolved against ``as_of``
    (explicit, so runs repeat). Literal bounds, so parquet pushes it down."""
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    lo = resolve_date(date_from, as_of)
    hi = resolve_date(date_to, as_of) + dt.timedelta(days=1)
    # Bounds cast from text: no session time zone is involved, and the
    # folded literals reach the parquet scan as pushed filters.
    start = F.lit(f"{lo.isoformat()} 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{hi.isoformat()} 00:00:00").cast("timestamp_ntz")
    c = _col(c)
    return (c >= start) & (c < end)


def author_string(names, of: DataFrame | None = None) -> Column:
    """', '-joined author names (B8). For a column of ``of`` that is
    array<struct<name: string, ..>> the structs' names are joined."""
    if of is not None and isinstance(names, str):
        kind = of.schema[names].dataType
        if isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            return author_struct_string(names)
    return F.array_join(_col(names), ", ")


def author_struct_string(authors) -> Column:
    return F.array_join(F.transform(_col(authors), lambda a: a["name"]), ", ")


def has_any_author(names, wanted: list[str]) -> Column:
    """The author array shares at least one name with ``wanted``."""
    return F.arrays_overlap(_col(names), F.array(*[F.lit(w) for w in wanted]))


def has_any_author_in_string(authors, wanted: list[str]) -> Column:
    return has_any_author(F.split(_col(authors), ", "), wanted)


def strip_version(c, strict_reference: bool = False) -> Column:
    """Id without its version suffix.

    Default: drop a trailing ``v<digits>``. ``strict_reference=True`` keeps
    the source pipeline's rule, the text before the first ``v`` (which cuts
    old-style ids such as ``solv-int/9901001v1`` to ``sol``).
    """
    c = _col(c)
    if strict_reference:
        return F.substring_index(c, "v", 1)
    return F.regexp_replace(c, r"v\d+$", "")


# Words that make an Atom comment count as an affiliation.
AFFILIATION_KEYWORDS = ["university", "institute", "lab", "corporation", "inc.", "company"]


def looks_like_affiliation(c) -> Column:
    """Lower-cased text contains one of the affiliation keywords."""
    pattern = "|".join(re.escape(k) for k in AFFILIATION_KEYWORDS)
    return F.lower(_col(c)).rlike(pattern)
