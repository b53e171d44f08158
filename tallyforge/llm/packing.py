"""Packing by power-of-two decomposition.

Each document's ids are cut into pieces of power-of-two length, longest first; a piece is a
sequence by itself, so no sequence crosses documents and none is padded.  Pieces of equal
length share a bucket, from which batches of one shape are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.llm.bpe import slices, text_encoder, text_sizes

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, bucket int"


def binary_cuts(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n ids: as many of `longest` as fit, then the binary digits of the rest."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write `pieces` under `path`/bucket=..., so that each folder holds sequences of one length, to be drawn in full batches."""
    pieces.write.partitionBy("bucket").parquet(path)


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", longest: int = 2048, end_id: int = 1, carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, bucket, sequence_id, offset, and the document's columns `carry`.

    A document's ids are those of its whole text (null: none) and then `end_id`; every id lies
    in exactly one piece.  `longest` is a power of two.  `bucket` is log2 of the length.
    sequence_id is unique in the result; offset is 0 as each sequence holds one piece.  Rows
    that repeat an id are separate documents; columns that are not carried are ignored, and
    those carried must have other names.  An empty table gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path, "library", cached_words=250_000)
        end = np.array([end_id], "<u4").tobytes()
        for whole in batches:
            for batch in slices(whole, text_sizes(whole.column("text"))):
                rows, starts, lengths, pieces, totals = [], [], [], [], []
                for row, text in enumerate(batch.column("text").to_pylist()):
                    raw = encoder.encode(text) + end
                    n, at = len(raw) // 4, 0
                    for length in binary_cuts(n, longest):
                        rows.append(row)
                        starts.append(at)
                        lengths.append(length)
                        pieces.append(raw[4 * at : 4 * (at + length)])
                        totals.append(n)
                        at += length
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(rows, pa.int32())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                        pa.array(pieces, pa.binary()), pa.array(totals, pa.int64()),
                        pa.array([n.bit_length() - 1 for n in lengths], pa.int32()), *(batch.column(c).take(pa.array(rows, pa.int32())) for c in carry),
                    ],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "bucket", *carry],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *carry)
    schema = T.StructType([*T.StructType.fromDDL(PIECES).fields, *(rows.schema[c] for c in carry)])
    return rows.mapInArrow(run, schema).withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )
