"""Table schemas.

One superset schema for the document table covers both variants of the
source pipeline: the plain one (six columns) and the relevance one (plus
``affiliation`` and the tri-state ``selected``: 'yes' / 'no' / NULL =
pending). Everything is text; NULL means "not filled yet".
"""

from pyspark.sql import types as T

S = T.StringType()

FULL_DOCUMENTS = T.StructType([
    T.StructField("id", S, False),
    T.StructField("title", S, True),
    T.StructField("authors", S, True),
    T.StructField("pdf_url", S, True),
    T.StructField("abstract", S, True),
    T.StructField("conclusion", S, True),
])

RELEVANCE_DOCUMENTS = T.StructType(FULL_DOCUMENTS.fields[:3] + [
    T.StructField("affiliation", S, True),
] + FULL_DOCUMENTS.fields[3:] + [
    T.StructField("selected", S, True),
])

SUMMARIES = T.StructType([
    T.StructField("id", S, False),
    T.StructField("summary", S, True),
])

SECTIONS = T.StructType([
    T.StructField("id", S, False),
    T.StructField("abstract", S, True),
    T.StructField("conclusion", S, True),
])


TABLES = {
    "full_documents": FULL_DOCUMENTS,
    "summaries": SUMMARIES,
}

RELEVANCE_TABLES = {
    "full_documents": RELEVANCE_DOCUMENTS,
    "summaries": SUMMARIES,
}
