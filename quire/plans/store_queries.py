"""Queries over stored tables: merges by bucket, versions, commit order, the
inverted index, all searches of a config at once, observed counters, and the
foreign-key rule at write. Each builds its tables from the whole of the driver's
tables, under the job's staged folder.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quire import schemas
from quire.functions.verdict import parse_verdict
from quire.operators import filters, upserts
from quire.operators.layout import stage
from quire.plans import fixtures
from quire.plans import queries as Q
from quire.session import scratch_path
from quire.sinks import tables
from quire.sinks.versions import VersionedTable

BUCKETS = 16
#: Subfolders that small files are written to.
FOLDERS = 256
#: Named searches in the config's shape; the oracle states them again in SQL.
SEARCHES = {
    "worlds": {"keywords": ['"world model" OR "world models"', '"ndre" OR "eauou"'], "max_results": 25},
    "recent": Q.SEARCH_CONFIG,
    "both": {"keywords": Q.SEARCH_BOOLEAN, "max_results": 10},
    "authors": {"keywords": ['"que" AND "tion"', "ti:die"], "authors": ["Author 2"]},
}


def folder(spark, name: str) -> str:
    return scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}")


def merged(spark, old: DataFrame, batch: DataFrame, apply, schema: StructType) -> DataFrame:
    """``old`` stored as a table of hash buckets, with ``batch`` merged in."""
    table = VersionedTable(spark, folder(spark, "table"), schema)
    table.create(BUCKETS)
    table.append(old)
    table.merge(batch, apply)
    return table.read()


def q_merged_replace(spark, sf):
    """G1 by bucket, every third key twice (as ``upsert_replace``)."""
    p = fixtures.papers_table(spark, sf)
    batch = p.filter(Q.IN_BATCH).select("id", "title", "authors", "pdf_url", F.lit(1).alias("seq"))
    again = p.filter(F.col("doc_id") % 9 == 0).select(
        "id", F.concat("title", F.lit(" (revised)")).alias("title"), "authors", "pdf_url", F.lit(2).alias("seq"))
    return merged(spark, Q.stored_documents(spark, sf, filled=True), batch.unionByName(again),
                  lambda old, new: upserts.upsert_replace(old, new, "id", seq="seq"), schemas.FULL_DOCUMENTS)


def q_merged_insert(spark, sf):
    new = Q.paper_ids(spark, sf, Q.IN_BATCH)
    return merged(spark, Q.stored_summaries(spark, sf), new.unionAll(new),
                  lambda old, new: upserts.insert_if_absent(old, new, "id"), schemas.SUMMARIES)


def q_merged_update(spark, sf):
    return merged(spark, Q.stored_documents(spark, sf, filled=False), Q.update_batch(spark, sf),
                  lambda old, new: upserts.partial_update(old, new, ["abstract", "conclusion"], "id", "seq"),
                  schemas.FULL_DOCUMENTS)


def q_merged_summary(spark, sf):
    new = Q.generated_summaries(spark, sf, where=F.expr(Q.IN_BATCH)).select("id", "summary")
    return merged(spark, Q.stored_summaries(spark, sf), new,
                  lambda old, new: upserts.upsert_summary(old, new, "id"), schemas.SUMMARIES)


def q_merged_selected(spark, sf):
    t = Q.relevance_table(spark, sf)
    verdicts = filters.pending(t).select("id", parse_verdict("model_response").alias("selected"))
    schema = StructType([StructField(c, StringType()) for c in ("id", "title", "authors", "affiliation", "selected")])
    return merged(spark, t, verdicts, lambda old, new: upserts.set_selected(old, new, "id"), schema).select(
        "id", "title", "selected")


def q_table_versions(spark, sf):
    """A table created, filled, merged into and cleared; rows and filled
    rows of every version, each read after the last commit."""
    table = VersionedTable(spark, folder(spark, "table"), schemas.FULL_DOCUMENTS)
    table.create(BUCKETS)
    table.append(Q.stored_documents(spark, sf, filled=False))
    table.merge(Q.update_batch(spark, sf),
                lambda old, new: upserts.partial_update(old, new, ["abstract", "conclusion"], "id", "seq"))
    last = table.clear()
    return reduce(DataFrame.unionByName, [
        table.read(v).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("abstract").isNotNull()).alias("n_filled"))
        .select(F.lit(v).alias("version"), "n", "n_filled") for v in range(last + 1)])


def q_sections_replayed(spark, sf):
    """An older batch replayed after a newer one, and a compaction; one
    current row per id, by the order of the first commits."""
    root = folder(spark, "store")
    s = stage(filters.with_any_section(Q.sections(spark, sf).select(
        "doc_id", F.col("paper_id").alias("id"), "abstract", "conclusion")), "sections")
    tables.write_sections(s, root, "first", 0)
    tables.write_sections(s.filter("doc_id % 3 = 0").withColumn(
        "abstract", F.concat("abstract", F.lit(" (revised)"))), root, "second", 0)
    tables.write_sections(s, root, "first", 0)
    tables.compact_sections(spark, root)
    from quire.sources.files import read_sections
    return read_sections(spark, root)


def q_search_indexed(spark, sf):
    """B1 by the inverted index, built from two batches, the second of which
    holds a third of the first's documents again, as they are."""
    from quire.operators.text_index import TextIndex

    docs = fixtures.papers(spark, sf).select("doc_id", F.col("paper_id").alias("id"), "title", "content")
    index = TextIndex(spark, folder(spark, "index"), ["title", "content"], BUCKETS)
    first = docs.filter("doc_id % 2 = 0")
    index.add(first.withColumn("title", F.when(F.col("doc_id") % 3 == 0, F.lit("que la ndre the of"))
                               .otherwise(F.col("title"))), 0)
    index.add(docs.filter(Q.IN_BATCH), 1)
    return index.search(Q.SEARCH_BOOLEAN).select(F.col("id").alias("paper_id"))


def q_searches_all(spark, sf):
    """B1 and B2 for all named searches, in one scan."""
    from quire.operators.many_searches import search_many

    p = fixtures.papers(spark, sf)
    return search_many(p, SEARCHES, Q.AS_OF, id_col="paper_id").withColumnRenamed("id", "paper_id")


def q_extraction_observed(spark, sf):
    """E2 of a whole extraction pass, counted while its tables are written: the
    papers but doc_id % 5 = 0 have a converted document, those with doc_id % 3 = 0
    are stored already."""
    from quire.plans import workflow

    root = folder(spark, "pass")
    p = fixtures.papers(spark, sf)
    tables.write_documents(p.filter("doc_id % 5 <> 0").select(F.col("paper_id").alias("id"), F.transform(
        "blocks", lambda b: F.create_map(F.lit("text"), b)).alias("texts")), f"{root}/in")
    s = stage(Q.sections(spark, sf, keep=["title", "author_names", "pdf_url"]), "sections")
    tables.write_sections(filters.with_any_section(s.filter("doc_id % 3 = 0")).select(
        F.col("paper_id").alias("id"), "abstract", "conclusion"), f"{root}/store", "before")
    filled = F.col("doc_id") % 3 == 0
    docs = s.select(F.col("paper_id").alias("id"), "title", F.array_join("author_names", ", ").alias("authors"), "pdf_url",
                    F.when(filled, F.col("abstract")).alias("abstract"), F.when(filled, F.col("conclusion")).alias("conclusion"))
    return workflow.extraction_pass(spark, docs, f"{root}/in", f"{root}/store", source="converted").counters


def q_labels_enforced(spark, sf):
    """The foreign-key rule at write: labels whose document is in the table are
    added, the others go to the rejected rows, with the reason."""
    docs = fixtures.table(spark, sf, "documents").filter("doc_id % 7 <> 0").select("doc_id")
    labels = fixtures.table(spark, sf, "labels").select("doc_id", "quality")
    labels = labels.withColumn("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("doc_id")))     # some have no key
    root = folder(spark, "labels")
    checked = tables.CheckedTable(spark, root, labels.schema, "doc_id")
    for half in (0, 1, 0):                                          # the first batch twice: added once
        checked.append(labels.filter(F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(2)) == half), docs, "w", half)
    return (checked.accepted.read().select("doc_id", "quality", F.lit(None).cast("string").alias("reason"))
            .unionByName(checked.rejected.read()))


def parsed_files(spark, sf, root: str) -> None:
    """One parsed-document JSON file per paper, named by its id."""
    from quire.sources.packed import write_files

    docs = fixtures.papers(spark, sf).select(F.concat("paper_id", F.lit(".json")).alias("name"), F.to_json(F.struct(
        F.transform("blocks", lambda b: F.struct(b.alias("text"))).alias("texts"))).alias("body"))
    write_files(docs, root, "name", "body", FOLDERS)


def q_parsed_files(spark, sf):
    """A2: one JSON file per paper, read as they are."""
    from quire.sources.files import read_parsed_documents

    root = folder(spark, "files")
    parsed_files(spark, sf, root)
    return read_parsed_documents(spark, root).select("id", "content")


def q_packed_files(spark, sf):
    """A2 from containers: the same files, packed first."""
    from quire.sources.packed import PackedFiles

    root = folder(spark, "files")
    parsed_files(spark, sf, f"{root}/in")
    packed = PackedFiles(spark, f"{root}/packed", BUCKETS)
    packed.refresh(f"{root}/in", "*.json")
    return packed.read_parsed()


def text_lines(content):
    """A ``parse_fn`` that SQL can mirror: the lines of a file; a bad one fails."""
    if content == b"bad":
        raise ValueError("bad file")
    return [{"text": line} for line in content.decode().split("\n")]


def binary_files(spark, sf, root: str) -> None:
    """One file per document: a first line and its text, or, for doc_id % 8 = 5,
    what can't be converted."""
    from quire.sources.packed import write_files

    docs = fixtures.paper_keys(spark, sf).select("doc_id", "paper_id").join(
        fixtures.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    write_files(docs.select(F.concat("paper_id", F.lit(".pdf")).alias("name"),
                            F.when(F.col("doc_id") % 8 != 5, F.concat(
                                F.lit("text\n"), F.coalesce("text", F.lit("")))).otherwise("bad").alias("body")), root, "name", "body", FOLDERS)


def q_binary_files(spark, sf):
    """A3: listing and bytes of binary files."""
    from quire.sources.files import list_files, read_binary_documents

    root = folder(spark, "files")
    binary_files(spark, sf, root)
    listed = list_files(spark, root, "*.pdf").select("id", "length")
    return listed.join(read_binary_documents(spark, root).select("id", F.sha2("content", 256).alias("sha256")), "id")


def q_conversion_observed(spark, sf):
    """A conversion job over files, of which doc_id % 4 = 0 have an
    output already; counted while it writes."""
    from quire.plans import workflow

    root = folder(spark, "files")
    binary_files(spark, sf, f"{root}/in")
    tables.write_documents(fixtures.paper_keys(spark, sf).where("doc_id % 4 = 0").select(
        F.col("paper_id").alias("id"), F.lit(None).cast("array<map<string,string>>").alias("texts")), f"{root}/out")
    return workflow.convert(spark, f"{root}/in", f"{root}/out", text_lines)


def q_answers_kept(spark, sf):
    """H3 by prompt hash: half of the papers first, then all of them; what was
    answered isn't sent again."""
    from quire.functions.prompts import summary_prompt
    from quire.operators.answers import AnswerStore

    s = stage(Q.sections(spark, sf).select("doc_id", "paper_id", summary_prompt("abstract", "conclusion").alias("prompt")),
              "prompts")
    answers = AnswerStore(spark, folder(spark, "answers"), BUCKETS)
    answers.generate(s.where("doc_id % 2 = 0"), "prompt", "generated", Q.prompt_heads, options={"n": 40}, batch_size=256)
    return answers.generate(s, "prompt", "generated", Q.prompt_heads, options={"n": 40}, batch_size=256).select(
        "paper_id", "generated")


QUERIES = {
    "parsed_files": q_parsed_files,
    "packed_files": q_packed_files,
    "binary_files": q_binary_files,
    "conversion_observed": q_conversion_observed,
    "answers_kept": q_answers_kept,
    "merged_replace": q_merged_replace,
    "merged_insert": q_merged_insert,
    "merged_update": q_merged_update,
    "merged_summary": q_merged_summary,
    "merged_selected": q_merged_selected,
    "table_versions": q_table_versions,
    "sections_replayed": q_sections_replayed,
    "search_indexed": q_search_indexed,
    "searches_all": q_searches_all,
    "extraction_observed": q_extraction_observed,
    "labels_enforced": q_labels_enforced,
}
