"""Batch jobs that call out of the JVM: text generation (H3) and document
conversion (H6).

They run as ``mapInPandas`` and ``mapInArrow``: Spark ships Arrow batches of rows to Python
workers, and the caller's function is built once per task (one client per
partition), never per row. Failures are caught per row and become a NULL
result or a 'failed' status, so one bad row does not fail the job; a lost
executor just reruns its tasks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import is_blank
from quire.operators.layout import lean

# ----------------------------------------------------------------- generation

# The stand-in generator's rule: the first one or two sentences of the section
# (a sentence ends at . ! or ? followed by space or the end).
LEAD_RE = r"(?s)^\s*((?:.*?[.!?](?:\s|\z)){1,2})"


def lead_summary(abstract, conclusion) -> Column:
    """Default summary, as a Column: the leading sentences of the abstract, or
    of the conclusion when there is no abstract, with whitespace runs collapsed;
    a section without a sentence end is taken whole. NULL without a section."""
    section = F.coalesce(*[F.when(~is_blank(c), F.col(c) if isinstance(c, str) else c)
                           for c in (abstract, conclusion)])

    def short(s):
        lead = F.regexp_extract(s, LEAD_RE, 1)
        text = F.when(lead != "", lead).otherwise(s)
        return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))
    # in a lambda, so that the section is evaluated once
    return F.get(F.transform(F.array(section), short), 0)


def _finish(texts: pd.Series) -> pd.Series:
    """Strip; empty or missing → None (a failed generation)."""
    out = texts.astype("object").where(texts.notna(), None)
    out = out.map(lambda s: s.strip() if isinstance(s, str) else None)
    return out.map(lambda s: s if s else None)


def generate(df: DataFrame, prompt_col: str, out_col: str,
             make_fn: Callable[..., Callable[[pd.Series], pd.Series]],
             partitions: int | None = None, options: dict | None = None) -> DataFrame:
    """Add ``out_col``: one generated text per prompt (H3).

    ``make_fn(**options)`` is called once per task and returns the batch
    function (prompts → texts); this is where a caller opens its model
    client, and ``options`` carries settings such as the model name or the
    system prompt. Outputs are stripped; empty, missing or failed ones are
    NULL. A NULL prompt is not sent. ``partitions`` bounds how many tasks
    (and so clients) run at once.
    """
    options = dict(options or {})
    schema = T.StructType(df.schema.fields + [T.StructField(out_col, T.StringType(), True)])
    if partitions:
        df = df.repartition(partitions)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_fn(**options)
        for pdf in batches:
            prompts = pdf[prompt_col]
            live = prompts.notna()
            out = pd.Series([None] * len(pdf), index=pdf.index, dtype="object")
            if live.any():
                try:
                    got = pd.Series(list(fn(prompts[live])), index=prompts[live].index)
                except Exception:
                    got = pd.Series({i: _call_one(fn, p) for i, p in prompts[live].items()},
                                    dtype="object")
                out.loc[got.index] = got
            yield pdf.assign(**{out_col: _finish(out)})

    return df.mapInPandas(run, schema)


def _call_one(fn, prompt):
    try:
        return list(fn(pd.Series([prompt])))[0]
    except Exception:
        return None


# ----------------------------------------------------------------- conversion

BLOCK_TAGS = {"title", "h1", "h2", "h3", "h4", "h5", "h6", "p", "li", "td", "th",
              "pre", "blockquote", "figcaption", "caption", "dt", "dd"}
SKIP_TAGS = {"script", "style", "noscript", "template"}


class _BlockParser(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str]] = []
        self._skip = 0
        self._buf: list[str] = []
        self._label: str | None = None

    def _flush(self):
        text = re.sub(r"\s+", " ", "".join(self._buf)).strip()
        if text and self._label:
            self.blocks.append((self._label, text))
        self._buf, self._label = [], None

    def handle_starttag(self, tag, attrs):
        if tag in SKIP_TAGS:
            self._skip += 1
        elif tag in BLOCK_TAGS and not self._skip:
            self._flush()
            self._label = tag

    def handle_endtag(self, tag):
        if tag in SKIP_TAGS:
            self._skip = max(0, self._skip - 1)
        elif tag in BLOCK_TAGS and not self._skip:
            self._flush()

    def handle_data(self, data):
        if not self._skip and self._label:
            self._buf.append(data)


def html_blocks(html: str) -> list[dict]:
    """Default ``parse_fn``: text blocks of an HTML page, as
    ``[{"label": tag, "text": text}, ...]`` (the parsed-document shape)."""
    p = _BlockParser()
    p.feed(html)
    p.close()
    p._flush()
    return [{"label": lab, "text": txt} for lab, txt in p.blocks]


#: Rows and bytes of content that are converted at a time; a longer one alone, whole.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 20

CONVERTED = T.StructType([
    T.StructField("texts", T.ArrayType(T.MapType(T.StringType(), T.StringType())), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("error", T.StringType(), True),
])


def convert_documents(df: DataFrame, content_col: str, keep: list[str],
                      parse_fn: Callable[[object], list[dict]] = html_blocks,
                      skip_col: str | None = None) -> DataFrame:
    """Convert each row's ``content_col`` (HTML text or file bytes) into text
    blocks with ``parse_fn`` (H6), in slices of bounded bytes, so that a task's
    memory doesn't follow its input. Output: ``keep`` columns plus
    ``texts`` (array<map<string,string>>), ``status`` ok / failed / skipped
    and ``error``. Rows where ``skip_col`` is true (the output already
    exists) are reported as skipped; their bytes do not go to Python.
    """
    skip = F.coalesce(F.col(skip_col), F.lit(False)) if skip_col else F.lit(False)
    src = df.filter(~skip).select(*keep, content_col)
    schema = T.StructType([f for f in src.schema.fields if f.name in keep] + CONVERTED.fields)

    def converted(rows):
        import pyarrow as pa

        texts, status, error = [], [], []
        for content in rows.column(len(keep)).to_pylist():
            try:
                blocks = parse_fn(content)
                texts.append([list({str(k): (None if v is None else str(v)) for k, v in b.items()}.items())
                              for b in blocks])
                status.append("ok"), error.append(None)
            except Exception as e:  # per-row catch, as the source pipeline
                texts.append(None), status.append("failed"), error.append(repr(e))
        return pa.RecordBatch.from_arrays(
            [*rows.columns[:len(keep)], pa.array(texts, pa.list_(pa.map_(pa.string(), pa.string()))),
             pa.array(status, pa.string()), pa.array(error, pa.string())], schema.names)

    def run(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:      # the blocks of a whole batch would be Python objects at once
                rows = batch.slice(at, SLICE_ROWS)
                while rows.num_rows > 1 and rows.column(len(keep)).nbytes > SLICE_BYTES:
                    rows = rows.slice(0, rows.num_rows // 2)
                yield converted(rows)
                at += rows.num_rows

    done = src.mapInArrow(lean(run), schema)
    if not skip_col:
        return done
    none = [F.lit("skipped") if f.name == "status" else F.lit(None).cast(f.dataType) for f in CONVERTED.fields]
    skipped = df.filter(skip).select(*keep, *[c.alias(f.name) for c, f in zip(none, CONVERTED.fields)])
    return done.unionByName(skipped)


def texts_to_json(texts_col: str = "texts"):
    """The parsed-document JSON text of a block list (for ``write_documents``)."""
    return F.to_json(F.struct(F.col(texts_col).alias("texts")))
