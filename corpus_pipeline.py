"""Corpus pipeline: language ID, line dedup, near-duplicate removal, packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of `documents`.
Null and empty texts: language ID rejects texts without a letter, null ones included; the
other stages accept whatever is left.  Ids may be null or repeat and rows may repeat: each row
is judged by itself in language ID and packed by itself; for the two de-duplicating stages see
there.  Columns beyond those of `documents` are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyforge.llm import jaccard_join, language_id, line_dedup, packing
from tallyforge.llm.queries import held_out, word_bpe
from tallyforge.llm.shared import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose language cannot be told, and names that of those which state none.

    A document without a prediction, as it is null or has no letter, goes.  All others
    stay; a null `lang` becomes the predicted one.  If nothing could be learned, there is no
    prediction to go by: documents with a letter stay and their `lang` remains null.
    """
    model = language_id.fit(docs.where(~held_out()))
    docs = docs.select(COLUMNS)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = language_id.predict(docs, model, unknown=None).where("lang_pred is not null")
    return told.withColumn("lang", F.coalesce("lang", "lang_pred")).select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages; a document that consisted of nothing else goes.

    The first occurrence, by id (null ids first), stays; rows that repeat id and text stay alike.
    """
    cut = line_dedup.passage_dedup(docs.select(COLUMNS))
    left = (F.col("n_removed_lines") == 0) | (F.length(F.trim("text")) > 0)
    return cut.where(left).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked at 0.8 on shingles of five words, one row stays: that of the smallest id, null ids last.

    Rows are told apart by id and text, so ids may repeat or be null: of rows of one id, the one
    of the smaller text hash comes first, and of rows that repeat both id and text the smallest
    by source, language and length.  Texts without words, null ones included, stay.
    Columns beyond those of `documents` are dropped.
    """
    docs = docs.select(COLUMNS)
    labelled = jaccard_join.labelled(docs).where("component IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "row_key")).alias("first")
    groups = materialize(labelled.groupBy("component").agg(F.count("*").alias("n"), first).where("n > 1").select("component", "first"), "groups")
    # One row per id and text that is not alone in its group, saying whether it is the one that stays.
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key"))
    marks = labelled.join(groups, "component").groupBy("doc_id", "row_key").agg(F.bool_or(stays).alias("stays"), F.count("*").alias("times"))
    marks = materialize(marks.select(F.col("doc_id").alias("__id"), "row_key", "stays", "times"), "marks")
    keyed = docs.withColumn("row_key", F.xxhash64("doc_id", "text"))
    rows = keyed.join(marks, keyed["doc_id"].eqNullSafe(marks["__id"]) & (keyed["row_key"] == marks["row_key"]), "left").drop(marks["row_key"])
    plain = rows.where("stays IS NULL OR (stays AND times = 1)")
    order = Window.partitionBy("doc_id", "row_key").orderBy("source", "lang", "n_chars")
    repeated = rows.where("stays AND times > 1").withColumn("n", F.row_number().over(order)).where("n = 1")
    return plain.select(COLUMNS).unionByName(repeated.select(COLUMNS))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each with its document's language; see tallyforge.llm.packing.  Each row is a document of its own, also if its id repeats."""
    return packing.pack(docs, word_bpe(), carry=("lang",)).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket", "lang"
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: Language ID and packing have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
