"""The registered opN_* queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import (
    bpe, chat_format, conversation_repair, exact_dedup, html_text, jaccard_join, language_id, line_dedup, packing, simhash, spelling, topk_search, warc_archive,
)
from tallyforge.llm.oracles import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(_table(spark, sf_dir, "embeddings"), F.pmod(F.col("vec_id"), F.lit(50)) == 0, k=5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), word_bpe())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    back = chat_format.read_chats(chat_format.format_chats(turns))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc_archive.archive_path(spark)
    warc_archive.write_archive(_table(spark, sf_dir, "pages"), path)
    back = warc_archive.read_archive(spark, path)
    checked = F.when(F.col("verified"), F.sha2("payload", 256)).otherwise(F.raise_error(F.lit("payload does not match its digest")))
    return back.select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), checked.alias("payload_digest"), "record_type", "refers_to"
    )


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, word_bpe()).drop("text"), word_bpe())
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def held_out() -> Column:
    """Rows that no model learns from: crc32 of the id as text leaves 2 modulo 4."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) == 2


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~held_out()))
    predicted = language_id.predict(docs.select("doc_id", "text"), model)
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.near_duplicates(docs, words=3, percent=90)


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text without its repeated passages, n_lines, n_removed_lines."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.passage_dedup(docs)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, bits=4)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(_table(spark, sf_dir, "conversations"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.damaged_words(_table(spark, sf_dir, "documents")), min_count=3, times=2)


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_packing": op2_packing,
    "op3_chat_format": op3_chat_format,
    "op4_warc_archive": op4_warc_archive,
    "op5_bpe": op5_bpe,
    "op6_language_id": op6_language_id,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_html_text": op8_html_text,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_simhash": op11_simhash,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}
