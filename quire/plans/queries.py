"""Named queries over the driver's tables: one per operator of the survey.

Every query reads ``documents`` (through ``fixtures.papers``) or another
given table, runs over all of it, and returns a DataFrame. In the update
queries every document has a role: the stored table holds those with
doc_id % 2 = 0 or doc_id % 3 = 0, the batch those with doc_id % 2 = 1 or
doc_id % 3 = 0 (so a third of all are in both, and none is in neither).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.affiliation import affiliations
from quire.functions.prompts import flag_missing, relevance_prompt, summary_prompt
from quire.functions.search import strip_version
from quire.functions.sections import assemble_text_blocks, parsed_document_content, with_sections
from quire.functions.text import default_text, first_tag_text, head_lines
from quire.functions.text import preview as preview_col
from quire.functions.verdict import parse_verdict
from quire.operators import aggregates, filters, generation, joins, upserts
from quire.operators.layout import fence, stage
from quire.plans import fixtures

# Parameters of the queries (the search config's shape: keyword expressions,
# author names, a symbolic date range, a result count).
SEARCH_KEYWORDS = ['"world model" OR "world models"', '"ndre" OR "eauou"']
SEARCH_MAX_RESULTS = 25
AUTHORS = ["Author 3", "Author 5"]
DATE_RANGE = ("lastWeek", "today")
AS_OF = "2024-01-20"
SEARCH_BOOLEAN = ['("ndre" AND "the of") ANDNOT "eauou"', 'ti:"que" AND "la"']
SKIPPED_PAGE_MOD = 4  # pages with page_id % 4 = 0 already have an output
IN_TABLE = "(doc_id % 2 = 0 or doc_id % 3 = 0)"
IN_BATCH = "(doc_id % 2 = 1 or doc_id % 3 = 0)"
# A named search in the config's shape (keywords, authors, date range, count).
SEARCH_CONFIG = {
    "keywords": ['"ndre" OR "eauou"', '"the of"'],
    "authors": ["Author 1", "Author 2", "Author 4"],
    "date_range": {"from": "lastWeek", "to": "today"},
    "max_results": 4,
}


# ------------------------------------------------------------------ fixtures

def sections(spark, sf, keep=(), with_content: bool = False, where: str = "true",
             with_labels: bool = False) -> DataFrame:
    """Extraction over all papers: (doc_id, paper_id, *keep, abstract,
    conclusion, status[, content]). Content is assembled from the text
    blocks by ``assemble_text_blocks``; one pass, no join."""
    p = fixtures.papers(spark, sf, with_labels).filter(where).select(
        "doc_id", "paper_id", *keep,
        assemble_text_blocks("blocks").alias("content"))
    out = with_sections(p)
    cols = ["doc_id", "paper_id", *keep, "abstract", "conclusion", "status"]
    return out.select(*cols, *(["content"] if with_content else []))


def stored_documents(spark, sf, filled: bool) -> DataFrame:
    """The document table as stored before a run (``IN_TABLE``); with
    extracted sections when ``filled``."""
    if filled:
        t = sections(spark, sf, keep=["title", "author_names", "pdf_url"])
    else:
        t = (fixtures.papers(spark, sf)
             .withColumn("abstract", F.lit(None).cast("string"))
             .withColumn("conclusion", F.lit(None).cast("string")))
    return (t.filter(IN_TABLE)
             .select(F.col("paper_id").alias("id"), "title",
                     F.array_join("author_names", ", ").alias("authors"),
                     "pdf_url", "abstract", "conclusion"))


def paper_ids(spark, sf, where: str = "true") -> DataFrame:
    """Ids of the papers with a role (one side of an update)."""
    return (fixtures.paper_keys(spark, sf).filter(where)
            .select(F.col("paper_id").alias("id")))


def parsed_file_stems(spark, sf) -> DataFrame:
    """Stems of the parsed-document files: every paper but doc_id % 5 = 0."""
    return (fixtures.paper_keys(spark, sf).filter(F.col("doc_id") % 5 != 0)
            .select(F.col("paper_id").alias("stem")))


def stored_summaries(spark, sf) -> DataFrame:
    return (fixtures.papers(spark, sf).filter(IN_TABLE)
            .select(F.col("paper_id").alias("id"),
                    F.concat(F.lit("Summary of "), F.col("title")).alias("summary")))


def generated_summaries(spark, sf, where=None) -> DataFrame:
    """Lead summary with its flags: (doc_id, id, summary); summary NULL where
    there is no section. ``where`` (on doc_id) picks the papers."""
    s = sections(spark, sf)
    if where is not None:
        s = s.filter(where)
    s = fence(s, ["abstract", "conclusion"])
    out = s.select("doc_id", F.col("paper_id").alias("id"), "abstract", "conclusion",
                   generation.lead_summary("abstract", "conclusion").alias("lead"))
    out = fence(out, ["lead"]).select("doc_id", "id", flag_missing("lead", "abstract", "conclusion").alias("summary"))
    return fence(out, ["summary"])


def prompt_heads(**options):
    """A caller's generator that SQL can mirror: the prompt's last characters."""
    n = options["n"]
    return lambda prompts: prompts.str.slice(-n)


# ------------------------------------------------------------------- queries

def q_extract_sections(spark, sf):
    return sections(spark, sf)


def q_parsed_sections(spark, sf):
    """Sections through the parsed-document JSON reader: papers are written
    as JSON text in the three shapes (block list, bare string, root text)
    and read back with ``parsed_document_content``."""
    p = fixtures.papers(spark, sf)
    blocks_json = F.to_json(F.struct(
        F.transform("blocks", lambda b: F.struct(b.alias("text"))).alias("texts")))
    bare_json = F.regexp_extract(F.to_json(F.struct(F.col("content").alias("t"))),
                                 r'(?s)^\{"t":(.*)\}$', 1)
    root_json = F.to_json(F.struct(F.col("content").alias("text")))
    raw = (F.when(F.col("doc_id") % 7 == 0, bare_json)
            .when(F.col("doc_id") % 7 == 1, root_json)
            .otherwise(blocks_json))
    docs = p.select("doc_id", "paper_id", parsed_document_content(raw).alias("content"))
    return with_sections(docs).select("doc_id", "paper_id", "abstract", "conclusion", "status")


def q_search_newest(spark, sf):
    p = fixtures.papers(spark, sf)
    hits = filters.search_papers(p, SEARCH_KEYWORDS, cols=("title", "content"))
    top = filters.newest(hits, SEARCH_MAX_RESULTS, by="submitted_at", tie="paper_id")
    return top.select("paper_id", "title", F.array_join("author_names", ", ").alias("authors"))


def q_config_search(spark, sf):
    from quire.plans.search import run_search
    p = fixtures.papers(spark, sf)
    top = run_search(p, SEARCH_CONFIG, AS_OF, id_col="paper_id")
    return top.select("paper_id", "title", F.array_join("author_names", ", ").alias("authors"))


def q_fetch_upsert(spark, sf):
    """The fetch step: the named search over the papers as a catalog,
    its hits replacing rows of the stored document table."""
    from quire.plans import workflow
    catalog = fixtures.papers(spark, sf).select(
        F.col("paper_id").alias("id"), "title", "author_names", "pdf_url",
        F.col("content").alias("summary"), "submitted_at")
    rows = workflow.search_hits(catalog, SEARCH_CONFIG, AS_OF)
    return upserts.upsert_replace(stored_documents(spark, sf, filled=True), rows, "id")


def q_stream_sections(spark, sf):
    """I1 end to end: the papers are written as converted documents under
    the shared checkpoint folder, a file stream (``availableNow``) extracts
    them into the sections store, and the store is returned."""
    import uuid

    from quire.session import scratch_path
    from quire.sinks.tables import write_documents
    from quire.sources.files import read_sections
    from quire.streaming.extract_stream import extract_stream

    root = scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex}")
    docs = fixtures.papers(spark, sf).select(
        F.col("paper_id").alias("id"),
        F.transform("blocks", lambda b: F.create_map(F.lit("text"), b)).alias("texts"))
    write_documents(docs, f"{root}/in")
    q = extract_stream(spark, f"{root}/in", f"{root}/store", f"{root}/checkpoint",
                       source="converted")
    q.awaitTermination()
    return read_sections(spark, f"{root}/store")


def q_row_counts(spark, sf):
    """Rows per table (E3): documents with a paper row, and the judged ones."""
    docs = aggregates.row_count(fixtures.paper_keys(spark, sf))
    judged = aggregates.row_count(fixtures.table(spark, sf, "labels"))
    return (docs.select(F.lit("full_documents").alias("table"), "n")
            .unionByName(judged.select(F.lit("labels").alias("table"), "n")))


def q_papers_with_url(spark, sf):
    return filters.with_url(fixtures.papers(spark, sf)).select("paper_id", "pdf_url")


def q_pending_papers(spark, sf):
    p = filters.pending(fixtures.papers(spark, sf, with_labels=True))
    return p.select(strip_version("paper_id").alias("id"), "title",
                    F.array_join("author_names", ", ").alias("authors"),
                    default_text("affiliation", "Not provided").alias("affiliation"))


def q_by_authors(spark, sf):
    p = filters.by_authors(fixtures.papers(spark, sf), AUTHORS, "author_names")
    return p.select("paper_id", F.array_join("author_names", ", ").alias("authors"))


def q_recent_events(spark, sf):
    e = fixtures.table(spark, sf, "events")
    return (filters.in_date_range(e, "ts", *DATE_RANGE, as_of=AS_OF)
            .select("event_id", "user_id", "event_type", "value"))


def q_affiliations(spark, sf):
    return fixtures.papers(spark, sf).select("paper_id", affiliations("atom_xml").alias("affiliation"))


def q_page_titles(spark, sf):
    pages = fixtures.spread_if_asked(fixtures.table(spark, sf, "pages").select("page_id", "html"))
    return pages.select("page_id", first_tag_text("html", "title").alias("title"))


def q_summaries_report(spark, sf):
    docs = fixtures.papers_table(spark, sf).select("id", "title")
    return joins.summaries_report(docs, generated_summaries(spark, sf))


def q_unprocessed(spark, sf):
    p = fixtures.paper_keys(spark, sf).select("paper_id")
    done = fixtures.paper_keys(spark, sf).filter(F.col("doc_id") % 3 == 0).select("paper_id")
    return joins.unprocessed(p, done, key="paper_id")


def q_missing_outputs(spark, sf):
    inputs = filters.with_url(fixtures.paper_keys(spark, sf)).select("paper_id", "pdf_url")
    outputs = (fixtures.paper_keys(spark, sf).filter(F.col("doc_id") % 4 == 0)
               .select(F.concat("paper_id", F.lit(".pdf")).alias("file_name")))
    stems = outputs.select(F.regexp_extract("file_name", r"^(.*)\.[^.]+$", 1).alias("stem"))
    return joins.missing_outputs(inputs, stems, key="paper_id", output_key="stem")


def q_match_known(spark, sf):
    new = paper_ids(spark, sf, IN_BATCH)
    table = paper_ids(spark, sf, IN_TABLE)
    return joins.match_known(new, table, "id").select(F.col("id").alias("paper_id"), "known")


def q_with_parsed_file(spark, sf):
    docs = paper_ids(spark, sf)
    files = parsed_file_stems(spark, sf)
    return joins.with_parsed_file(docs, files, "id", "stem").select(
        F.col("id").alias("paper_id"), "has_file")


def q_selection_stats(spark, sf):
    return aggregates.selection_stats(fixtures.papers(spark, sf, with_labels=True))


def extraction_outcomes(spark, sf) -> DataFrame:
    """One row per stored document: ok / skipped / failed, as an extraction
    pass decides: no parsed file → failed; already in the sections store →
    skipped; else extracted, ok when a section was found."""
    table = paper_ids(spark, sf)
    files = parsed_file_stems(spark, sf)
    done = paper_ids(spark, sf, "doc_id % 3 = 0").select(F.col("id").alias("done_id"))
    # only what is to do is extracted: a file is there, and it is not done
    s = sections(spark, sf, where="doc_id % 5 <> 0 and doc_id % 3 <> 0").select(
        F.col("paper_id").alias("id"), "abstract", "conclusion")
    tagged = joins.flag_exists(joins.with_parsed_file(table, files, "id", "stem"),
                               done, "done", "id", "done_id")
    found = tagged.join(s, "id", "left")
    outcome = (F.when(~F.col("has_file"), F.lit("failed"))
                .when(F.col("done"), F.lit("skipped"))
                .when(F.col("abstract").isNotNull() | F.col("conclusion").isNotNull(), F.lit("ok"))
                .otherwise(F.lit("failed")))
    return found.select("id", outcome.alias("outcome")), files, done


def q_extraction_counters(spark, sf):
    outcomes, files, done = extraction_outcomes(spark, sf)
    return aggregates.extraction_counters(outcomes, files, done)


def converted_pages(spark, sf) -> DataFrame:
    pages = fixtures.spread_if_asked(fixtures.table(spark, sf, "pages").select("page_id", "html"))
    pages = pages.withColumn("exists", F.col("page_id") % SKIPPED_PAGE_MOD == 0)
    return generation.convert_documents(pages, "html", ["page_id"], skip_col="exists")


def q_converted_pages(spark, sf):
    c = converted_pages(spark, sf)
    return c.select("page_id", "status", F.size("texts").alias("n_blocks"),
                    F.get("texts", 0)["text"].alias("first_block"))


def q_conversion_counters(spark, sf):
    return aggregates.conversion_counters(converted_pages(spark, sf))


def q_upsert_replace(spark, sf):
    old = stored_documents(spark, sf, filled=True)
    p = fixtures.papers_table(spark, sf)
    batch = p.filter(IN_BATCH).select("id", "title", "authors", "pdf_url", F.lit(1).alias("seq"))
    again = p.filter(F.col("doc_id") % 9 == 0).select("id", F.concat("title", F.lit(" (revised)")).alias("title"),
                                                      "authors", "pdf_url", F.lit(2).alias("seq"))
    return upserts.upsert_replace(old, batch.unionByName(again), "id", seq="seq")


def q_insert_if_absent(spark, sf):
    old = stored_summaries(spark, sf)
    new = paper_ids(spark, sf, IN_BATCH)
    return upserts.insert_if_absent(old, new.unionAll(new), "id")    # every key twice


def q_partial_update(spark, sf):
    """Every key of the batch twice: first its abstract alone, then its
    conclusion alone; both must land."""
    old = stored_documents(spark, sf, filled=False)
    return upserts.partial_update(old, update_batch(spark, sf), ["abstract", "conclusion"], "id", "seq")


def update_batch(spark, sf) -> DataFrame:
    """(id, seq, abstract, conclusion): two rows per key, one column each."""
    s = sections(spark, sf, where=IN_BATCH)
    none = F.lit(None).cast("string")
    rows = F.array(F.struct(F.lit(1).alias("seq"), F.col("abstract"), none.alias("conclusion")),
                   F.struct(F.lit(2).alias("seq"), none.alias("abstract"), F.col("conclusion")))
    return s.select(F.col("paper_id").alias("id"), F.inline(rows))


def q_upsert_summary(spark, sf):
    old = stored_summaries(spark, sf)
    new = generated_summaries(spark, sf, where=F.expr(IN_BATCH)).select("id", "summary")
    return upserts.upsert_summary(old, new, "id")


def relevance_table(spark, sf) -> DataFrame:
    p = fixtures.papers(spark, sf, with_labels=True)
    return p.select(F.col("paper_id").alias("id"), "title",
                    F.array_join("author_names", ", ").alias("authors"), "affiliation",
                    "selected", "model_response")


def q_set_selected(spark, sf):
    t = relevance_table(spark, sf)
    verdicts = filters.pending(t).select("id", parse_verdict("model_response").alias("selected"))
    return upserts.set_selected(t.drop("model_response"), verdicts, "id").select(
        "id", "title", "selected")


def q_verify_update(spark, sf):
    old = stored_documents(spark, sf, filled=False)
    cols = ["abstract", "conclusion"]
    # the batch is reduced and written once, for the update and for the check
    new = upserts.reduce_update(update_batch(spark, sf), cols, "id", "seq")
    return upserts.verify_update(upserts.apply_update(old, new, cols, "id"), new, cols, "id")


def q_sections_appended(spark, sf):
    # the old store and the new batch both come from one extraction: written once
    s = stage(sections(spark, sf).select("doc_id", F.col("paper_id").alias("id"),
                                         "abstract", "conclusion"), "sections")
    found = filters.with_any_section(s)
    previous = found.filter(F.col("doc_id") % 3 == 0).drop("doc_id")
    return upserts.append_new(previous, found.drop("doc_id"), "id")


def q_dump_rows(spark, sf):
    from quire.sinks.tables import keyed_json
    t = sections(spark, sf, keep=["title", "author_names", "pdf_url"])
    return keyed_json(t.select(F.col("paper_id").alias("id"), "title", F.array_join("author_names", ", ")
                               .alias("authors"), "pdf_url", "abstract", "conclusion"), "id")


def q_summary_prompt(spark, sf):
    s = filters.summarisable(sections(spark, sf))
    return s.select("paper_id", summary_prompt("abstract", "conclusion").alias("prompt"))


def q_flag_missing(spark, sf):
    s = sections(spark, sf, keep=["title"])
    return s.select("paper_id", flag_missing("title", "abstract", "conclusion").alias("summary"))


def q_lead_summary(spark, sf):
    return generated_summaries(spark, sf).select(F.col("id").alias("paper_id"), "summary")


def q_generated_texts(spark, sf):
    """H3 with a caller's generator: one batch call per task over the prompts."""
    s = sections(spark, sf).select("paper_id", summary_prompt("abstract", "conclusion").alias("prompt"))
    out = generation.generate(s, "prompt", "generated", prompt_heads, options={"n": 40})
    return out.select("paper_id", "generated")


def q_search_boolean(spark, sf):
    """B1 with AND, ANDNOT, brackets and a field."""
    p = filters.search_papers(fixtures.papers(spark, sf), SEARCH_BOOLEAN, cols=("title", "content"))
    return p.select("paper_id")


def q_sections_current(spark, sf):
    """A4 over a store with a document extracted twice: every section is stored
    under one writer, then the papers with doc_id % 3 = 0 again, revised, under
    another; one current row per id."""
    import uuid

    from quire.session import scratch_path
    from quire.sinks.tables import write_sections
    from quire.sources.files import read_sections

    root = scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/store-{uuid.uuid4().hex}")
    s = stage(filters.with_any_section(sections(spark, sf).select(
        "doc_id", F.col("paper_id").alias("id"), "abstract", "conclusion")), "sections")
    write_sections(s, root, "first")
    write_sections(s.filter("doc_id % 3 = 0").withColumn("abstract", F.concat("abstract", F.lit(" (revised)"))),
                   root, "second")
    return read_sections(spark, root)


def q_read_papers(spark, sf):
    """A1: the document table written out and read back with its schema."""
    import uuid

    from quire.session import scratch_path
    from quire.sources.files import read_papers

    root = scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/papers-{uuid.uuid4().hex}")
    stored_all = fixtures.papers_table(spark, sf).select(
        "id", "title", "authors", "pdf_url", F.lit(None).cast("string").alias("abstract"),
        F.lit(None).cast("string").alias("conclusion"))
    stored_all.write.parquet(root)
    return read_papers(spark, root, ["id", "title", "pdf_url"])


def q_read_converted(spark, sf):
    """G10 and its reader: documents written as JSON lines and assembled again."""
    import uuid

    from quire.session import scratch_path
    from quire.sinks.tables import write_documents
    from quire.sources.files import read_converted_documents

    root = scratch_path(spark, f"staged/{spark.sparkContext.applicationId}/converted-{uuid.uuid4().hex}")
    docs = fixtures.papers(spark, sf).select(F.col("paper_id").alias("id"), F.transform(
        "blocks", lambda b: F.create_map(F.lit("text"), b)).alias("texts"))
    write_documents(docs, root)
    return read_converted_documents(spark, root)


def q_strict_ids(spark, sf):
    """B9 by the strict rule (the text before the first v), and the file stem."""
    from quire.sources.files import file_stem

    p = fixtures.paper_keys(spark, sf).withColumn("file_name", F.concat("paper_id", F.lit(".tar.gz")))
    return p.select("paper_id", strip_version("paper_id", strict_reference=True).alias("id"),
                    file_stem("file_name").alias("stem"))


def q_converted_lines(spark, sf):
    """H6 with a ``parse_fn`` that SQL can mirror: text to line blocks."""
    docs = fixtures.table(spark, sf, "documents").select("doc_id", "text")
    c = generation.convert_documents(docs, "text", ["doc_id"], line_blocks)
    return c.select("doc_id", "status", F.size("texts").alias("n_blocks"),
                    F.get("texts", 0)["text"].alias("first_block"))


def line_blocks(text):
    return [{"text": line} for line in text.split("\n")]


def q_orphan_labels(spark, sf):
    """Foreign-key check: labels whose document isn't in the table."""
    from quire.sinks.tables import orphans

    docs = fixtures.table(spark, sf, "documents").filter("doc_id % 7 <> 0")
    return orphans(fixtures.table(spark, sf, "labels").select("doc_id", "quality"), docs, "doc_id")


def q_relevance_prompt(spark, sf):
    # one pass over the pending papers: extraction and prompt, no self-join
    s = sections(spark, sf, keep=["title", "author_names", "affiliation"], where="selected is null",
                 with_labels=True).withColumn("authors", F.array_join("author_names", ", "))
    return s.select(F.col("paper_id").alias("id"),
                    relevance_prompt("title", "authors", "affiliation", "abstract").alias("prompt"))


def q_verdicts(spark, sf):
    p = fixtures.papers(spark, sf, with_labels=True)
    return p.select("paper_id", parse_verdict("model_response").alias("verdict"))


def q_preview(spark, sf):
    s = sections(spark, sf, with_content=True)
    return s.select("paper_id", preview_col("abstract", 100).alias("abstract_preview"),
                    head_lines("content", 5).alias("content_head"))


QUERIES = {
    "extract_sections": q_extract_sections,
    "parsed_sections": q_parsed_sections,
    "search_newest": q_search_newest,
    "config_search": q_config_search,
    "row_counts": q_row_counts,
    "fetch_upsert": q_fetch_upsert,
    "stream_sections": q_stream_sections,
    "papers_with_url": q_papers_with_url,
    "pending_papers": q_pending_papers,
    "by_authors": q_by_authors,
    "recent_events": q_recent_events,
    "affiliations": q_affiliations,
    "page_titles": q_page_titles,
    "summaries_report": q_summaries_report,
    "unprocessed": q_unprocessed,
    "missing_outputs": q_missing_outputs,
    "match_known": q_match_known,
    "with_parsed_file": q_with_parsed_file,
    "selection_stats": q_selection_stats,
    "extraction_counters": q_extraction_counters,
    "converted_pages": q_converted_pages,
    "conversion_counters": q_conversion_counters,
    "upsert_replace": q_upsert_replace,
    "insert_if_absent": q_insert_if_absent,
    "partial_update": q_partial_update,
    "upsert_summary": q_upsert_summary,
    "set_selected": q_set_selected,
    "verify_update": q_verify_update,
    "sections_appended": q_sections_appended,
    "dump_rows": q_dump_rows,
    "summary_prompt": q_summary_prompt,
    "flag_missing": q_flag_missing,
    "lead_summary": q_lead_summary,
    "relevance_prompt": q_relevance_prompt,
    "generated_texts": q_generated_texts,
    "search_boolean": q_search_boolean,
    "sections_current": q_sections_current,
    "read_papers": q_read_papers,
    "read_converted": q_read_converted,
    "strict_ids": q_strict_ids,
    "converted_lines": q_converted_lines,
    "orphan_labels": q_orphan_labels,
    "verdicts": q_verdicts,
    "preview": q_preview,
}

from quire.plans.store_queries import QUERIES as _STORE_QUERIES  # noqa: E402  (it uses the fixtures above)

QUERIES |= _STORE_QUERIES
