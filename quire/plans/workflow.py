"""The corpus jobs end to end: extraction pass, summarisation, relevance.

Each job returns DataFrames (new table contents and counters); writing
them is the caller's step (``quire.sinks.tables``), which is also the
lineage cut between jobs: a job reads the tables the previous one wrote.
The extraction pass is the exception: it writes its new sections itself,
so that the expensive extraction runs once for all of its outputs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quire.functions.prompts import flag_missing_flags, relevance_prompt, summary_prompt
from quire.functions.sections import with_sections
from quire.functions.text import is_blank
from quire.functions.verdict import parse_verdict
from quire.operators import aggregates, filters, generation, joins, upserts
from quire.operators.layout import stage
from quire.sinks.tables import read_batch, write_documents, write_sections
from quire.sources.files import (list_files, read_converted_documents, read_parsed_documents,
                                  read_section_rows)


@dataclass
class ExtractionRun:
    documents: DataFrame      # next version of the document table
    new_sections: DataFrame   # (id, abstract, conclusion) written to the store by this run
    outcomes: DataFrame       # (id, outcome) per document: ok / skipped / failed
    counters: DataFrame       # one row of run statistics
    writer: str               # the name of this run's batch in the sections store


def extraction_pass(spark: SparkSession, documents: DataFrame, parsed_dir: str,
                    sections_path: str, sections_file_name: str | None = None,
                    source: str = "parsed") -> ExtractionRun:
    """One extraction pass over the document table.

    ``source`` is ``"parsed"`` (one JSON document per file, id = file stem) or
    ``"converted"`` (JSON lines as ``sinks.tables.write_documents`` writes them).

    Per document: no parsed file → failed; already in the sections store
    *and* still filled in the table → skipped (a re-fetched row whose
    sections were wiped is extracted again); else the sections are
    extracted, and a document with at least one section is ok and is
    recorded, one with none is failed and will be tried again next run.

    Ids come from the file listing (or the id column), staged once; the texts
    are read once, for the extraction. The new sections are written to the store
    here (this is the only step that runs the regex cascade), under a writer name
    of this run; the table update, outcomes and counters are then read from what
    was written.
    """
    exclude = [sections_file_name] if sections_file_name else None
    if source == "converted":
        files = read_converted_documents(spark, parsed_dir)
        ids_of_files = files.select("id")
    else:
        files = read_parsed_documents(spark, parsed_dir, exclude=exclude)
        ids_of_files = list_files(spark, parsed_dir, "*.json", exclude).select("id")
    # every count is taken while its rows are written: nothing is read again for it
    seen = {name: Observation(name) for name in ("files", "store", "tagged", "extracted")}
    rows = F.count(F.lit(1)).alias("n")
    ids_of_files = stage(ids_of_files.observe(seen["files"], rows), "files")
    # the store as it is now: this run's own batch is not part of it
    store = stage(read_section_rows(spark, sections_path).select("id").distinct().observe(seen["store"], rows), "store")
    filled = documents.filter(F.col("abstract").isNotNull() | F.col("conclusion").isNotNull())
    done = joins.known_only(store, filled.select("id"), "id")

    ids = documents.select("id")
    tagged = joins.flag_exists(joins.flag_exists(ids, ids_of_files, "has_file", "id"), done, "done", "id")
    tagged = stage(tagged.observe(seen["tagged"], rows,
                                  F.count_if(F.col("has_file") & F.col("done")).alias("skipped")), "tagged")
    todo = tagged.filter(F.col("has_file") & ~F.col("done")).select("id")
    extracted = with_sections(joins.known_only(files.select("id", "content"), todo, "id"),
                              status=None).select("id", "abstract", "conclusion")
    if source == "converted":      # lines may repeat an id; a folder's files can't
        extracted = upserts.latest_per_key(extracted, "id")
    extracted = extracted.observe(seen["extracted"], F.count_if(
        F.col("abstract").isNotNull() | F.col("conclusion").isNotNull()).alias("ok"))
    writer = f"pass-{uuid.uuid4().hex}"
    write_sections(filters.with_any_section(extracted), sections_path, writer)
    found = read_batch(spark, sections_path, writer)

    outcome = (F.when(~F.col("has_file"), F.lit("failed"))
                .when(F.col("done"), F.lit("skipped"))
                .when(F.col("found"), F.lit("ok"))
                .otherwise(F.lit("failed")))
    outcomes = (joins.flag_exists(tagged, found, "found", "id")
                .select("id", outcome.alias("outcome")))
    new_docs = upserts.partial_update(documents, found, ["abstract", "conclusion"], "id")
    told = seen["tagged"].get
    counters = aggregates.observed_extraction(
        spark, total=told["n"], files=seen["files"].get["n"], stored=seen["store"].get["n"],
        ok=seen["extracted"].get["ok"], skipped=told["skipped"])
    return ExtractionRun(new_docs, found, outcomes, counters, writer)


def convert(spark: SparkSession, in_dir: str, out_dir: str, parse_fn, glob: str = "*.pdf") -> DataFrame:
    """The conversion job: list the inputs, skip those with an output before any
    byte is read (D4), convert the rest with ``parse_fn`` (bytes to blocks),
    write their documents (G10), and return the counters (E4): one row with
    total, ok, failed, skipped. Run again, it converts what failed or is new."""
    from quire.sources.files import read_binary_documents

    seen = {name: Observation(name) for name in ("listed", "todo", "done")}
    rows = F.count(F.lit(1)).alias("n")
    listed = stage(list_files(spark, in_dir, glob).select("id").observe(seen["listed"], rows), "inputs")
    try:
        known = spark.read.schema("id string").json(out_dir)
    except AnalysisException:      # nothing has been written yet
        known = spark.createDataFrame([], "id string")
    todo = stage(joins.missing_outputs(listed, known).observe(seen["todo"], rows), "todo")
    inputs = read_binary_documents(spark, in_dir, glob, only=todo)
    done = generation.convert_documents(inputs, "content", ["id"], parse_fn).observe(
        seen["done"], F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") != "ok").alias("failed"))
    write_documents(done.filter(F.col("status") == "ok"), out_dir)      # converted, counted and written in one pass
    total, todo_n = seen["listed"].get["n"], seen["todo"].get["n"]
    return spark.createDataFrame([(total, seen["done"].get["ok"], seen["done"].get["failed"], total - todo_n)],
                                 "total long, ok long, failed long, skipped long")


def summarise(documents: DataFrame, summaries: DataFrame, make_fn=None,
              partitions: int | None = None, options: dict | None = None) -> DataFrame:
    """Summarise every paper with a section and upsert the results; a failed
    generation keeps the previous summary. Returns the next summaries table.
    Without ``make_fn`` the summary is the lead of the section, a Column; with
    it, prompts go to the caller's generator, and ``options`` (e.g. ``model``,
    ``system_prompt``) to ``make_fn``."""
    src = filters.summarisable(documents.select("id", "abstract", "conclusion"))
    blank = [is_blank("abstract").alias("no_abstract"), is_blank("conclusion").alias("no_conclusion")]
    if make_fn is None:
        gen = src.select("id", generation.lead_summary("abstract", "conclusion").alias("generated"), *blank)
    else:
        prompts = src.select("id", summary_prompt("abstract", "conclusion").alias("prompt"), *blank)
        gen = generation.generate(prompts, "prompt", "generated", make_fn, partitions, options)
    new = gen.select("id", flag_missing_flags("generated", "no_abstract", "no_conclusion")
                     .alias("summary"))
    return upserts.upsert_summary(summaries, new, "id")


def judge_relevance(documents: DataFrame, make_fn, partitions: int | None = None,
                    options: dict | None = None):
    """Judge pending papers (``selected IS NULL``) by their affiliation and
    write yes/no. Any failure is a final 'no'. Returns (next document
    table, selection statistics)."""
    todo = filters.pending(documents).select(
        "id", relevance_prompt("title", "authors", "affiliation", "abstract").alias("prompt"))
    answers = generation.generate(todo, "prompt", "answer", make_fn, partitions, options)
    verdicts = answers.select("id", parse_verdict("answer").alias("selected"))
    updated = upserts.set_selected(documents, verdicts, "id")
    return updated, aggregates.selection_stats(updated)


def search_hits(catalog: DataFrame, config: dict, as_of,
                text_cols=("title", "summary")) -> DataFrame:
    """The named search over a paper catalog (the remote search re-aimed at
    a table with ``id, title, author_names, pdf_url, summary,
    submitted_at``), as the fetch step stores it: (id, title, authors,
    pdf_url). Staged, so the search runs once for every table it feeds."""
    from quire.functions.search import author_string
    from quire.plans.search import run_search

    hits = run_search(catalog, config, as_of, text_cols=text_cols, id_col="id")
    return stage(hits.select("id", "title", author_string("author_names", hits).alias("authors"),
                             "pdf_url"), "fetch")


def fetch(catalog: DataFrame, documents: DataFrame, summaries: DataFrame, config: dict,
          as_of, text_cols=("title", "summary")):
    """The fetch step: replace the search hits in the document table (their
    sections become NULL, as a re-fetch does) and add their ids to the
    summaries table if absent. Returns (next documents, next summaries)."""
    rows = search_hits(catalog, config, as_of, text_cols)
    return (upserts.upsert_replace(documents, rows, "id"),
            upserts.insert_if_absent(summaries, rows.select("id"), "id"))


def fetch_with_affiliations(catalog: DataFrame, documents: DataFrame, summaries: DataFrame,
                            config: dict, as_of, strict_ids: bool = False,
                            text_cols=("title", "summary")):
    """The relevance variant of fetch: ids without version, affiliations
    from the Atom entry (``atom_xml``), the abstract filled from the
    catalog summary, and ``selected`` reset to pending."""
    from quire.functions.affiliation import affiliations
    from quire.functions.search import author_string, strip_version
    from quire.plans.search import run_search

    hits = run_search(catalog, config, as_of, text_cols=text_cols, id_col="id")
    rows = stage(hits.select(strip_version("id", strict_ids).alias("id"), "title",
                             author_string("author_names", hits).alias("authors"),
                             affiliations("atom_xml").alias("affiliation"), "pdf_url",
                             F.col("summary").alias("abstract")), "fetch")
    return (upserts.upsert_replace(documents, rows, "id"),
            upserts.insert_if_absent(summaries, rows.select("id"), "id"))


def download_todo(documents: DataFrame, downloaded: DataFrame) -> DataFrame:
    """Papers with a PDF link whose file is not there yet: (id, pdf_url).
    ``downloaded`` is a file listing (``sources.files.list_files``)."""
    return joins.missing_outputs(filters.with_url(documents).select("id", "pdf_url"),
                                 downloaded.select("id"), "id")
