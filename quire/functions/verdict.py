"""Model verdict parsing (H5).

A verdict is a JSON object with a required boolean ``is_prestigious`` and a
required string ``reason``; a valid one with a true flag is 'yes', and
anything else (unparseable, missing field, wrong type) is 'no'.

``from_json`` is too lenient for this: it turns ``"yes"`` into NULL,
accepts a numeric reason and ignores a missing one. Parsing into VARIANT
keeps the JSON types, so each field's type is tested exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Strings accepted as a true boolean (lower-cased).
TRUE_STRINGS = ["1", "on", "t", "true", "y", "yes"]

# The JSON parser stops after the first value, so "{...}}" or "{...} x"
# would parse. Wrapping the text as the first element of an array that ends
# with a sentinel string makes any trailing token either a parse error or a
# displaced sentinel, so "exactly one JSON value" can be tested.
_SENTINEL = "\u0000end-of-answer"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def verdict_is_true(response) -> Column:
    r = _col(response)
    wrapped = F.try_parse_json(F.concat(F.lit("["), r, F.lit(',"\\u0000end-of-answer"]')))
    whole = ((F.try_variant_get(wrapped, "$[1]", "string") == F.lit(_SENTINEL))
             & F.try_variant_get(wrapped, "$[2]", "variant").isNull())
    v = F.try_variant_get(wrapped, "$[0]", "variant")
    flag = F.try_variant_get(v, "$.is_prestigious", "variant")
    reason = F.try_variant_get(v, "$.reason", "variant")
    ftype = F.schema_of_variant(flag)
    truthy = (
        ((ftype == "BOOLEAN") & F.try_variant_get(flag, "$", "boolean"))
        | ((ftype == "STRING")
           & F.lower(F.try_variant_get(flag, "$", "string")).isin(TRUE_STRINGS))
        | ((ftype.isin("BIGINT", "DOUBLE", "FLOAT") | ftype.startswith("DECIMAL"))
           & (F.try_variant_get(flag, "$", "double") == 1.0)))
    valid = (whole & F.schema_of_variant(v).startswith("OBJECT")
             & (F.schema_of_variant(reason) == "STRING"))
    return F.coalesce(valid & truthy, F.lit(False))


def parse_verdict(response) -> Column:
    """'yes' or 'no'."""
    return F.when(verdict_is_true(response), F.lit("yes")).otherwise(F.lit("no"))
