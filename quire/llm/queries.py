"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.llm.common import remainder, table


def op1_quality_rules(spark, sf_dir):
    from quire.llm import quality_rules

    return quality_rules.score(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op2_deleted_interpolation(spark, sf_dir):
    from quire.llm import interpolation

    return interpolation.score(table(spark, sf_dir, "documents"))


def op3_language_crf(spark, sf_dir):
    from quire.llm import language_crf

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder(F.col("doc_id"), 3) == 1
    model = language_crf.fit(docs.where(~held))
    return language_crf.predict(docs.select("doc_id", "text", held.alias("held_out")), model).select(
        "doc_id", "held_out", "lang_pred", "score", "confidence")


def op4_exact_topk(spark, sf_dir):
    from quire.llm import topk

    return topk.search(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


def op5_source_mix(spark, sf_dir):
    from quire.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark, sf_dir):
    import public_tokenizers

    from quire.llm import token_counts

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def op7_quality_classifier(spark, sf_dir):
    from quire.llm import quality_classifier

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = remainder(F.col("doc_id"), 5) == 0
    labels = table(spark, sf_dir, "labels").where(~held)
    model = quality_classifier.fit(docs, labels)
    return quality_classifier.score(docs.select("doc_id", "text", held.alias("held_out")), model).select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_jaccard_join(spark, sf_dir):
    from quire.llm import jaccard_join

    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op9_pieces(spark, sf_dir):
    import public_tokenizers

    from quire.llm import pieces

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "n_pieces", "n_byte_pieces", "score", "round_trip", "ids")


def op10_warc_revisits(spark, sf_dir):
    from quire.llm import warc

    records = warc.captures(table(spark, sf_dir, "pages"))
    headers = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(
        e["key"], F.lit(": "), e["value"])), "\n")
    return warc.resolve(records).select("record_id", "url_key", "resolution", "response_id", "status",
                                        headers.alias("headers"))


def op11_cover_codes(spark, sf_dir):
    from quire.llm import cover_codes

    return cover_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_chat_parts(spark, sf_dir):
    from quire.llm import chat

    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lit(False).alias("added"))
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"), F.lit(True).alias("added"))
    chats = chat.format_chats(said.unionByName(probe), keep=("added",))
    return chat.digest(chats, keep=("added",)).drop("added")


def op13_target_resampling(spark, sf_dir):
    from quire.llm import resampling

    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_deleted_interpolation, op3_language_crf, op4_exact_topk, op5_source_mix, op6_token_counts,
    op7_quality_classifier, op8_jaccard_join, op9_pieces, op10_warc_revisits,
    op11_cover_codes, op12_chat_parts, op13_target_resampling)}
