"""WARC: not-modified revisit resolution.

A revisit record (a 304 answer) is resolved to the latest earlier full response
of the same canonical URL by an as-of join, its validators are checked against
that response, and the headers that a 304 may update are merged into the
response's. Only keys, times and ids travel through the as-of join; headers
are joined afterwards by record id, payloads only by ``with_payload``.

The as-of join is split by ranges of (URL, time), so a URL with a third of all
records is spread over many tasks: the latest response inside a range by a
window, the one from earlier ranges by one row per URL and range.

Defined cases: a null URL or time resolves to nothing (``missing``); records
with the same URL and time are ordered by record id; identical rows stay
separate rows; a record that is neither a full response (type ``response``,
status 200) nor a revisit is passed over; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import stage

#: Header fields that a 304 answer carries for the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")


def canonical_url(url: Column) -> Column:
    """Host in lower case without default port, path, and the query's fields in
    order without tracking fields; scheme and fragment are left out."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1)), r":(80|443)$", "")
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)", 1)
    fields = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&"),
                                   lambda x: (x != "") & ~x.startswith("utm_")))
    query = F.when(F.size(fields) > 0, F.concat(F.lit("?"), F.array_join(fields, "&"))).otherwise("")
    return F.concat(host, F.when(path == "", "/").otherwise(path), query)


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then agree, the last stays."""
    names = F.map_keys(headers)
    pairs = F.filter(F.transform(F.map_entries(headers), lambda e: F.struct(
        F.lower(e["key"]).alias("key"), e["value"].alias("value"))), lambda e: e["key"].isNotNull())
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(names), F.lit(1))),
                                                  lambda x: x["key"] == e["key"]))
    return F.map_from_entries(F.coalesce(last, F.array().cast("array<struct<key:string,value:string>>")))


def as_of(records: DataFrame) -> DataFrame:
    """(row, response) for every row of ``records(key, ts, record_id, full, row)``:
    the row id of the latest full record of its key before it."""
    placed = stage(records.select("key", "ts", "record_id", "full", "row")
                   .repartitionByRange("key", "ts", "record_id", "row")
                   .withColumn("part", F.spark_partition_id()), "captures")
    order = ["ts", "record_id", "row"]
    earlier = (Window.unboundedPreceding, -1)
    at = F.when(F.col("full"), F.col("row"))
    inside = F.last(at, ignorenulls=True).over(
        Window.partitionBy("part", "key").orderBy(*order).rowsBetween(*earlier))
    last = placed.groupBy("key", "part").agg(F.max_by("row", F.when(F.col("full"), F.struct(*order))).alias("r"))
    carried = last.select("key", "part", F.last("r", ignorenulls=True).over(
        Window.partitionBy("key").orderBy("part").rowsBetween(*earlier)).alias("carried"))
    return (placed.withColumn("inside", inside).join(carried, ["key", "part"])
            .select("row", F.coalesce("inside", "carried").alias("response")))


def resolve(records: DataFrame) -> DataFrame:
    """One row per revisit of ``records(record_id, url, ts, type, status, headers)``:
    record_id, url_key, response_id, resolution, status and the merged headers.

    resolution is ``resolved`` (validators agree), ``conflict`` (they differ),
    ``unproven`` (no validator in common) or ``missing`` (no earlier response).
    An entity tag decides before a modification time; tags compare weakly.
    Only a resolved revisit gets the response's status and headers.
    """
    base = stage(records.select(
        "record_id", canonical_url(F.col("url")).alias("key"), F.col("ts"),
        ((F.col("type") == "response") & (F.col("status") == 200)).alias("full"),
        (F.col("type") == "revisit").alias("revisit"), "status", lower_names(F.col("headers")).alias("headers"))
        .withColumns({c: F.coalesce(c, F.lit(False)) for c in ("full", "revisit")})
        .where("full or revisit").withColumn("row", F.monotonically_increasing_id()), "records")
    pairs = as_of(base.where("key is not null and ts is not null"))
    revisits = base.where("revisit").join(pairs, "row", "left")
    stored = base.where("full").select(
        F.col("row").alias("response"), F.col("record_id").alias("response_id"),
        F.col("status").alias("r_status"), F.col("headers").alias("r_headers"))
    both = revisits.join(stored, "response", "left")

    def tag(h):
        return F.regexp_replace(F.trim(F.element_at(h, "etag")), "^W/", "")

    def same(read):
        return read(F.col("headers")) == read(F.col("r_headers"))
    agree = F.coalesce(same(tag), same(lambda h: F.trim(F.element_at(h, "last-modified"))))
    how = (F.when(F.col("response_id").isNull() & F.col("r_headers").isNull(), "missing")
           .when(agree.isNull(), "unproven").when(agree, "resolved").otherwise("conflict"))
    update = F.map_filter("headers", lambda name, _: name.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter("r_headers", lambda name, _: ~F.map_contains_key(update, name)), update)
    done = F.col("resolution") == "resolved"
    return both.withColumn("resolution", how).select(
        "record_id", F.col("key").alias("url_key"), "ts", "resolution",
        F.col("response_id"), F.when(done, F.col("r_status")).otherwise(F.col("status")).alias("status"),
        F.when(done, merged).otherwise(F.col("headers")).alias("headers"))


def with_payload(resolved: DataFrame, records: DataFrame, payload_col="payload") -> DataFrame:
    """The resolved revisits with their response's payload; others have null."""
    bodies = records.select(F.col("record_id").alias("response_id"), F.col(payload_col).alias("payload"))
    keyed = resolved.withColumn("want", F.when(F.col("resolution") == "resolved", F.col("response_id")))
    return keyed.join(bodies.withColumnRenamed("response_id", "want"), "want", "left").drop("want")


def captures(pages: DataFrame) -> DataFrame:
    """A crawl over ``pages(page_id, url, html)``: four records for every page.

    A full response; two revisits a day and two days later, by other spellings
    of the URL, whose validators agree, differ or are absent by page_id; and
    either a changed response three days later or a revisit before the first.
    """
    p = pages.select("page_id", "url", F.md5(F.coalesce("html", F.lit("")).cast("binary")).alias("tag"),
                     F.length("html").alias("n"), F.explode(F.array(*map(F.lit, range(4)))).alias("c"))
    t = F.col("page_id") * 7
    full = "(c = 0 or c = 3 and page_id % 4 = 0)"
    return p.select(
        (F.col("page_id") * 4 + F.col("c")).alias("record_id"),
        F.expr("case c when 1 then concat(regexp_replace(url, '#.*$', ''), '#again') "
               "when 2 then concat(upper(substring_index(url, '://', 1)), '://', substring_index(url, '://', -1)) "
               "else url end").alias("url"),
        (t + F.expr(f"case when c < 3 then c * 86400 when {full} then 259200 else -100000 end")).alias("ts"),
        F.expr(f"case when {full} then 'response' else 'revisit' end").alias("type"),
        F.expr(f"case when {full} then 200 else 304 end").alias("status"),
        F.expr(f"""map_filter(map(
            'ETag', case when c = 0 then concat('"', tag, '"')
                         when {full} then concat('"', tag, '-2"')
                         when c = 2 and page_id % 5 = 0 then '"other"'
                         when c = 2 and page_id % 5 in (1, 2) then null
                         when page_id % 3 = 0 then concat('W/"', tag, '"') else concat('"', tag, '"') end,
            'Last-Modified', case when c = 2 and page_id % 5 = 2 then null else concat('day ', page_id % 100) end,
            'Cache-Control', concat('max-age=', c * 60),
            'Content-Length', cast(case when {full} then n else 0 end as string),
            'Date', concat('t', cast(c as string))), (k, v) -> v is not null)""").alias("headers"))
