"""Affiliations from an Atom metadata entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.search import looks_like_affiliation
from quire.functions.text import first_tag_text, tag_texts

AFFILIATION_TAGS = ["arxiv:affiliation", "affiliation"]
COMMENT_TAG = "arxiv:comment"


def affiliation_list(xml) -> Column:
    """Distinct affiliation texts, sorted: every plain-text affiliation
    element, plus the first comment when it reads like an affiliation.
    A regex scan rather than ``xpath``, which fails the whole job on one
    malformed entry; here a malformed entry just yields what it holds."""
    tags = tag_texts(xml, AFFILIATION_TAGS)
    comment = first_tag_text(xml, COMMENT_TAG)
    found = F.when(comment.isNotNull() & looks_like_affiliation(comment),
                   F.concat(tags, F.array(comment))).otherwise(tags)
    return F.array_sort(F.array_distinct(found))


def affiliations(xml) -> Column:
    """'; '-joined affiliations, NULL when there are none."""
    found = affiliation_list(xml)
    return F.when(F.size(found) > 0, F.array_join(found, "; "))
