"""Chat formatting with typed content parts, in DataFrame operations only.

A turn's content is a list of parts: text, image, audio or document. A visitor
over the parts flattens them into one string, in order: text is escaped, any
other part becomes a placeholder, and its attachment is recorded as (kind, ref,
tokens), tokens being the number that the placeholder expands to. The k-th
placeholder of a conversation belongs to its k-th attachment.

A turn is written as ``<s>`` role ``[INST]`` content ``[/INST]</s>``. Control
strings inside roles and texts are escaped by one ``~`` after their first
character, and one more for each that is there already, which is reversible and
leaves no control string in an escaped text.

Conversations are built in two steps, blocks of turns first, so that a long
conversation isn't gathered turn by turn in one task. The output keeps the
blocks as ``fragments`` (text, spans, attachments); the formatted conversation is
their texts one after another. ``spans`` is the loss mask of a fragment: start and
length, in characters, of each assistant content.

Defined cases: turns order by turn (null first), then role, then text, so rows
that repeat a turn all stay; a null role or text is empty; a null list has no
parts, and null parts are left out; parts of an unknown or null kind become the
placeholder ``<other>`` with 0 tokens; images without a size, audio without a
duration and documents without pages have 0 tokens; a null conversation id is one
conversation; an empty table gives no rows; extra columns are ignored. A
conversation is one row, so its formatted text must fit Spark's 2 GB a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, ROLE_END, TURN_END = "<s>", "[INST]", "[/INST]</s>"
KINDS = ("image", "audio", "document", "other")
#: What follows the first character of a control string.
_CONTROL = r"/?s>|/?INST\]|(?:image|audio|document|other)>"
ESCAPE = rf"([<\[])(~*(?:{_CONTROL}))"
UNESCAPE = rf"([<\[])~(~*(?:{_CONTROL}))"

#: A content part; which measures count depends on its kind.
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE, "$1~$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2")


def text_part(text: Column) -> Column:
    """One text part."""
    none = F.lit(None)
    return F.struct(F.lit("text").alias("kind"), text.cast("string").alias("text"), none.cast("string").alias("ref"),
                    none.cast("int").alias("width"), none.cast("int").alias("height"),
                    none.cast("double").alias("seconds"), none.cast("int").alias("pages"))


def expanded_tokens(part: Column, patch: int = 28, per_second: float = 12.5, per_page: int = 512) -> Column:
    """Tokens that a part's placeholder stands for: an image's patches with one
    row mark a row, an audio's frames, a document's pages."""
    rows = F.ceil(part["height"] / patch)
    image = rows * (F.ceil(part["width"] / patch) + 1)
    tokens = (F.when(part["kind"] == "image", image)
              .when(part["kind"] == "audio", F.ceil(part["seconds"] * per_second))
              .when(part["kind"] == "document", part["pages"].cast("long") * per_page))
    return F.greatest(F.coalesce(tokens.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))


def visit(parts: Column, **sizes) -> tuple[Column, Column]:
    """(content, attachments) of a list of parts, in their order."""
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    known = F.array(*[F.lit(k) for k in KINDS])

    def kind(p):
        return F.when(F.array_contains(known, p["kind"]), p["kind"]).otherwise("other")

    def is_text(p):
        return F.coalesce(p["kind"] == "text", F.lit(False))

    content = F.array_join(F.transform(parts, lambda p: F.when(is_text(p), escape(F.coalesce(p["text"], F.lit(""))))
                                       .otherwise(F.concat(F.lit("<"), kind(p), F.lit(">")))), "")
    attached = F.transform(F.filter(parts, lambda p: ~is_text(p)), lambda p: F.struct(
        kind(p).alias("kind"), p["ref"].alias("ref"), expanded_tokens(p, **sizes).alias("tokens")))
    return content, attached


def format_chats(turns: DataFrame, id_col="conv_id", turn_col="turn", role_col="role", text_col="text",
                 parts_col: str | None = None, keep: tuple[str, ...] = (), learn: str = "assistant",
                 block_turns: int = 128, **sizes) -> DataFrame:
    """(conv_id, *keep, fragments, expanded_tokens), one row per conversation.

    The content is ``parts_col`` (array of ``PART``) or, without one, the text.
    ``keep`` names columns that tell conversations apart beside the id. ``learn``
    is the role whose contents the loss covers.
    """
    parts = F.col(parts_col) if parts_col else F.array(text_part(F.coalesce(F.col(text_col), F.lit(""))))
    content, attached = visit(parts, **sizes)
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    rows = turns.select(F.col(id_col).alias("conv_id"), *keep, F.col(turn_col).cast("long").alias("turn"),
                        role.alias("role"), content.alias("content"), attached.alias("attached"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / block_turns))
    gathered = rows.groupBy("conv_id", *keep, "block").agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "content", "attached"))).alias("turns"))
    head = F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(ROLE_END)))
    texts = gathered.withColumn("heads", head).withColumn(
        "ends", F.aggregate(F.arrays_zip(F.transform("heads", F.length).alias("h"),
                                         F.transform("turns", lambda t: F.length(t["content"])).alias("c")),
                            F.array().cast("array<bigint>"),
                            lambda acc, x: F.concat(acc, F.array(
                                F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0).cast("long")) + x["h"] + x["c"]
                                + F.lit(len(TURN_END))))))
    fragment = F.struct(
        F.array_join(F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["content"], F.lit(TURN_END))), "").alias("text"),
        F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == learn, F.struct(
            (F.get("ends", i) - len(TURN_END) - F.length(t["content"])).alias("start"),
            F.length(t["content"]).cast("long").alias("length")))), lambda s: s.isNotNull()).alias("spans"),
        F.flatten(F.transform("turns", lambda t: t["attached"])).alias("attachments"))
    fragments = texts.select("conv_id", *keep, "block", fragment.alias("fragment"))
    whole = fragments.groupBy("conv_id", *keep).agg(F.sort_array(F.collect_list(
        F.struct("block", "fragment"))).alias("blocks"))
    whole = whole.select("conv_id", *keep, F.transform("blocks", lambda b: b["fragment"]).alias("fragments"))
    tokens = F.aggregate("fragments", F.lit(0).cast("long"), lambda n, f: n + F.aggregate(
        f["attachments"], F.lit(0).cast("long"), lambda m, a: m + a["tokens"]))
    return whole.withColumn("expanded_tokens", tokens)


def formatted(fragments: Column) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(fragments, lambda f: f["text"]), "")


def read_turns(text: Column) -> Column:
    """The turns (role, content still escaped) of a formatted text."""
    pieces = F.split(text, r"\[/INST\]</s>")
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    head = lambda t: F.substring_index(t, ROLE_END, 1)
    return F.transform(pieces, lambda t: F.struct(
        unescape(F.substring(head(t), F.lit(len(OPEN) + 1), F.length(t))).alias("role"),
        F.substring(t, F.length(head(t)) + len(ROLE_END) + 1, F.length(t)).alias("content")))


def read_loss(fragment: Column) -> Column:
    """The unescaped text under a fragment's loss mask."""
    return F.array_join(F.transform(fragment["spans"], lambda s: unescape(
        F.substring(fragment["text"], (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digest(chats: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the formatted conversations say, read back from them: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    read = chats.select("conv_id", *keep, "fragments", F.transform("fragments", lambda f: F.struct(
        read_turns(f["text"]).alias("turns"), read_loss(f).alias("loss"))).alias("back"))
    said = F.array_join(F.transform("back", lambda b: F.array_join(F.transform(b["turns"], lambda t: F.concat(
        t["role"], F.lit("\n"), unescape(t["content"]), F.lit("\n"))), "")), "")
    loss = F.array_join(F.transform("back", lambda b: b["loss"]), "")
    count = F.aggregate("back", F.lit(0).cast("long"), lambda n, b: n + F.size(b["turns"]))
    chars = F.aggregate("fragments", F.lit(0).cast("long"), lambda n, f: n + F.length(f["text"]))
    read = read.select("conv_id", *keep, count.alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       loss.alias("loss"), chars.alias("formatted_chars"))
    return read.select("conv_id", *keep, "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
                       F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
