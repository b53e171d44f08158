"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (1 to 3, a blended spectrum)
present in both, normalised by the sizes of their sets: a landmark's whole set, and of any other
text those n-grams that some landmark has (all others are in no landmark).  Landmark texts give a Nyström
approximation, on which one-versus-rest kernel ridge regression is solved; texts are scored
by two batched matrix products.  Fitting uses a bounded sample, scoring every whole text.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.bpe import slices, text_sizes
from tallyforge.llm.shared import Scratch


@dataclass(frozen=True)
class Params:
    """Bounds of the fit: `per_language` distinct rows are sampled per language, of which `landmarks_per_language` are landmarks."""

    per_language: int = 250
    landmarks_per_language: int = 24
    ridge: float = 1e-2


#: Bits of a symbol: letters are lower-cased code points plus 1, marks code points plus 1, and 1 is a space.
SYMBOL_BITS = 21
SPACE = 1


def _symbol(c: str) -> int:
    """Letters, lower-cased, and the marks that combine with them; all else is a space."""
    return ord(c.lower()[0]) + 1 if unicodedata.category(c)[0] in "LM" else SPACE


@functools.cache
def _table() -> np.ndarray:
    """Symbols of the first 65536 code points."""
    return np.array([_symbol(chr(code)) for code in range(1 << 16)], np.int64)


def symbols(text: str) -> np.ndarray:
    """Symbols of a text, framed by spaces; every run of other characters than letters is one space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    wide = codes >= 1 << 16
    s = _table()[np.where(wide, 0, codes)]
    if wide.any():
        found, back = np.unique(codes[wide], return_inverse=True)
        s[wide] = np.array([_symbol(chr(c)) for c in found.tolist()], np.int64)[back]
    s = np.concatenate(([SPACE], s, [SPACE]))
    return s[~((s == SPACE) & np.concatenate(([False], s[:-1] == SPACE)))]


def grams(text: str, most: int = 1 << 20) -> Iterator[np.ndarray]:
    """All n-grams of a text as 63-bit numbers, in parts that overlap by two characters."""
    for at in range(0, max(len(text), 1), most):
        s = symbols(text[max(at - 2, 0) : at + most])
        pairs = s[:-1] << SYMBOL_BITS | s[1:]
        yield from (s, pairs, pairs[:-1] << SYMBOL_BITS | s[2:])


def gram_set(text: str) -> np.ndarray:
    """The sorted distinct n-grams of a text."""
    out = np.zeros(0, np.int64)
    for part in grams(text):
        out = np.union1d(out, part)
    return out


class Vocabulary:
    """Places of known n-grams: a hash table with one probe, and a search for the few that share a slot."""

    BITS = 22
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, known: np.ndarray):
        self.known = known
        slot = self._slot(known)
        self.table = np.full(1 << self.BITS, -1, np.int32)
        self.table[slot] = np.arange(len(known), dtype=np.int32)
        shared = np.bincount(slot, minlength=1 << self.BITS)[slot] > 1 if len(known) else np.zeros(0, bool)
        self.table[slot[shared]] = -2

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes.view(np.uint64) * self.FACTOR >> np.uint64(64 - self.BITS)).astype(np.int64)

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Places of those `codes` that are known."""
        at = self.table[self._slot(codes)]
        crowded = codes[at == -2]
        codes, at = codes[at >= 0], at[at >= 0]
        out = at[self.known[at] == codes]
        if len(crowded):
            found = np.searchsorted(self.known, crowded).clip(max=len(self.known) - 1)
            out = np.concatenate((out, found[self.known[found] == crowded].astype(np.int32)))
        return out

    def presence(self, texts: list[str]) -> np.ndarray:
        """Rows of 0/1 over the known n-grams, each scaled to length one."""
        out = np.zeros((len(texts), len(self.known)), np.float32)
        for row, text in zip(out, texts, strict=True):
            for part in grams(text):
                row[self.places(part)] = 1
        return out / np.sqrt(np.maximum(out.sum(1, keepdims=True), 1))


@dataclass
class Landmarks:
    """The known n-grams, and which of them each landmark text holds."""

    known: np.ndarray
    held: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Landmarks:
        known = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
        held = np.zeros((len(sets), len(known)), bool)
        for row, own in zip(held, sets, strict=True):
            row[np.searchsorted(known, own)] = True
        return cls(known, held)

    def kernel(self):
        """A function from texts to their kernels with the landmarks."""
        vocabulary = Vocabulary(self.known)
        marks = self.held.T.astype(np.float32)
        marks /= np.sqrt(np.maximum(marks.sum(0, keepdims=True), 1))
        return lambda texts: vocabulary.presence(texts) @ marks

    @property
    def batch_rows(self) -> int:
        """Texts whose rows over the known n-grams take about 32 MB."""
        return int(np.clip((1 << 23) // max(len(self.known), 1), 1, 128))


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray

    def scorer(self):
        kernel, weights = self.landmarks.kernel(), self.weights.astype(np.float32)
        return lambda texts: kernel(texts) @ weights


def fit(labelled: DataFrame, params: Params = Params(), key_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from a bounded sample of rows with a language and a text; None if there are none.

    The sample holds, of each language, the `per_language` rows of the smallest hash of key
    and length among those below a limit that leaves about eight times as many; rows that
    repeat key and text count once.  Of each, one kernel row reaches the driver, and of the
    landmarks their n-grams.  Letters are lower-cased; n-grams are not cut in number.
    Null ids are as good as any; rows without language or text are left out, and of an empty
    table there is no model.
    """
    rows = labelled.select(
        F.col(lang_col).alias("lang"),
        F.xxhash64(F.lit(17), F.col(key_col).cast("string"), F.length(text_col)).alias("h"),
        F.col(text_col).alias("text"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    scratch = Scratch(labelled.sparkSession, "language-id")
    share = F.least(F.lit(1.0), F.lit(8.0 * params.per_language) / F.col("n"))
    limits = scratch.save(rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).select("lang", share.alias("share")), "limits")
    # One row a language is broadcast.  Texts of the sample alone are moved, each once.
    low = rows.join(F.broadcast(limits), "lang").where(F.col("h") / F.lit(2.0**64) + F.lit(0.5) <= F.col("share"))
    once = low.groupBy("lang", "h", F.xxhash64(F.lit(1), "text").alias("t")).agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))
    sample = scratch.save(once.withColumn("r", rank).where(F.col("r") <= params.per_language), "sample")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(i, 1), batch.column("r").slice(i, 1), pa.array([gram_set(text).astype("<i8").tobytes()], pa.binary())],
                    names=["lang", "r", "grams"],
                )

    marks = sample.where((F.col("r") <= params.landmarks_per_language) & F.col("text").rlike(r"\p{L}")).select("lang", "r", "text")
    got = sorted((r["lang"], r["r"], bytes(r["grams"])) for r in marks.mapInArrow(sets_of, "lang string, r int, grams binary").collect())
    landmarks = Landmarks.of([np.frombuffer(x[2], "<i8").astype(np.int64) for x in got])
    shipped = labelled.sparkSession.sparkContext.broadcast(landmarks)

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = shipped.value.kernel()
        for whole in batches:
            for at in range(0, whole.num_rows, shipped.value.batch_rows):
                batch = whole.slice(at, shipped.value.batch_rows)
                k = kernel(batch.column("text").to_pylist()).astype(np.float64)
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("r"), pa.array(list(k), pa.list_(pa.float64()))], names=["lang", "r", "k"])

    table = sample.select("lang", "r", "text").mapInArrow(kernels, "lang string, r int, k array<double>").collect()
    scratch.drop("limits", "sample")
    if not table:
        return None
    table = sorted((r["lang"], r["r"], r["k"]) for r in table)
    languages = sorted({x[0] for x in table})
    k = np.array([x[2] for x in table]).reshape(len(table), len(got))
    y = np.array([[1.0 if lang == name else 0.0 for name in languages] for lang, _, _ in table])
    # Nyström features K(x, L) W^-1/2, then ridge regression on 0/1 targets.
    held = landmarks.held.astype(np.float64)
    held /= np.sqrt(np.maximum(held.sum(1, keepdims=True), 1))
    values, vectors = np.linalg.eigh(held @ held.T)
    keep = values > 1e-6 * values.max(initial=0)
    root = vectors[:, keep] / np.sqrt(values[keep])
    phi = k @ root
    inner = phi.T @ phi + params.ridge * len(phi) / max(phi.shape[1], 1) * np.eye(phi.shape[1])
    return Model(languages, landmarks, root @ np.linalg.solve(inner, phi.T @ y))


def predict(
    docs: DataFrame, model: Model | None, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", unknown: str | None = "und"
) -> DataFrame:
    """`docs` plus the predicted language and its score from 0 to 1 (the ridge output, clipped).

    `unknown` with score 0 if the text is null or has no letters, or if nothing was learned.
    Of languages with equal scores the first by name counts.  Rows that repeat are predicted
    alike, and no id is looked at; an empty table gives no rows.  Columns of the two output
    names are replaced; all others pass unchanged.
    """
    docs = docs.drop(lang_col, score_col)
    nothing = {lang_col: F.lit(unknown).cast("string"), score_col: F.lit(0.0)}
    if model is None:
        return docs.withColumns(nothing)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        score, batch_rows = model.scorer(), model.landmarks.batch_rows
        names = np.array([*model.languages, unknown], object)
        for whole in batches:
            for part in slices(whole, text_sizes(whole.column(text_col))):
                for at in range(0, part.num_rows, batch_rows):
                    batch = part.slice(at, batch_rows)
                    texts = [t or "" for t in batch.column(text_col).to_pylist()]
                    got = score(texts)
                    best = got.argmax(1)
                    value = np.clip(got[np.arange(len(texts)), best], 0, 1).astype(np.float64)
                    empty = np.array([not any(map(str.isalpha, t)) for t in texts], bool)
                    best[empty], value[empty] = len(names) - 1, 0
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(names[best], pa.string()), pa.array(value)], names=[*batch.schema.names, lang_col, score_col]
                    )

    schema = docs.withColumns({lang_col: F.lit("").cast("string"), score_col: F.lit(0.0)}).schema
    schema[lang_col].nullable = True
    return docs.mapInArrow(run, schema)
