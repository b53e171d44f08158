"""BPE encoding and decoding.

A segment tree over adjacent pair ranks gives the next merge: its root is the lowest rank,
leftmost among equals, and a merge updates three leaves in logarithmic time, so a word of
any length takes O(n log n).  Texts are cut at white space, which no token spans; a bounded
cache in each Python worker holds the ids of recent words.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NO_PAIR = 1 << 100


def byte_letters() -> list[str]:
    """The printable stand-in of each byte value: itself if visible in Latin-1, else 256, 257, ..."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


#: What `TextEncoder` does to a text before its words are found, as vocabulary files spell it.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
}


class SegmentTreeBpe:
    """Merges of one vocabulary, with an end-of-word suffix on the last symbol of a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        if data.get("normalizer") != NORMALIZER or [x["type"] for x in data["pre_tokenizer"].get("pretokenizers", [])] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path} normalises or splits texts in another way than this encoder does")
        vocab, suffix = data["model"]["vocab"], data["model"]["end_of_word_suffix"]
        self.tokens = [""] * (1 + max([*vocab.values(), *(t["id"] for t in data["added_tokens"])]))
        for token, i in vocab.items():
            self.tokens[i] = token
        self.special = {}
        for t in data["added_tokens"]:
            self.tokens[t["id"]] = t["content"]
            self.special[t["content"]] = t["id"]
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + suffix] for x in letters]
        # Pair of ids (first * 2^20 + second) -> rank * 2^20 + id of the merged symbol.
        self.ranks = {}
        for rank, merge in enumerate(data["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        self.letters = dict(enumerate(letters))
        split = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split).findall

    def spelled(self, word: str) -> str:
        """A pre-token with each byte of its UTF-8 form as that byte's letter."""
        return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)

    def merge(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        raw = word.encode("utf-8", "surrogatepass")
        symbols = list(map(self.inner.__getitem__, raw))
        symbols[-1] = self.last[raw[-1]]
        n = len(symbols)
        if n == 1:
            return symbols
        ranks, size, bits = self.ranks.get, 1 << (n - 2).bit_length(), n.bit_length()
        up, low20 = 20 + bits, (1 << 20) - 1
        # A leaf holds (rank, position, merged id), so the minimum is the leftmost lowest rank.
        tree = [NO_PAIR] * (2 * size)
        left = symbols[0]
        for i in range(n - 1):
            right = symbols[i + 1]
            found = ranks(left << 20 | right)
            if found is not None:
                tree[size + i] = found >> 20 << up | i << 20 | found & low20
            left = right
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        where = (1 << bits) - 1
        while (root := tree[1]) != NO_PAIR:
            i = root >> 20 & where
            j = after[i]
            symbols[i] = root & low20
            symbols[j] = -1
            after[i] = k = after[j]
            changed = [(j, NO_PAIR)] if j < n - 1 else []
            if k < n:
                before[k] = i
                found = ranks(symbols[i] << 20 | symbols[k])
                changed.append((i, NO_PAIR if found is None else found >> 20 << up | i << 20 | found & low20))
            else:
                changed.append((i, NO_PAIR))
            if i:
                h = before[i]
                found = ranks(symbols[h] << 20 | symbols[i])
                changed.append((h, NO_PAIR if found is None else found >> 20 << up | h << 20 | found & low20))
            for at, value in changed:
                k = size + at
                if tree[k] == value:
                    continue
                tree[k] = value
                k >>= 1
                while k:
                    a, b = tree[2 * k], tree[2 * k + 1]
                    if a > b:
                        a = b
                    if tree[k] == a:
                        break
                    tree[k] = a
                    k >>= 1
        return [x for x in symbols if x >= 0]


class _Cache(dict):
    """A dict that fills itself; of two generations of `most` entries the older one is dropped, so common words stay."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        if len(key) <= 100:
            self[key] = value
        return value


class TextEncoder:
    """Whole texts to little-endian 32-bit ids; `merge` maps a pre-token to its ids."""

    odd_space = regex.compile(r"[\x1c-\x1f]")
    space = regex.compile(r"[\t-\r \x85\xa0  -     　]+")

    def __init__(self, bpe: SegmentTreeBpe, merge: Callable[[str], list[int]], cached_words: int):
        self.bpe = bpe
        self.pieces = _Cache(lambda piece: np.array(merge(piece), "<u4").tobytes(), cached_words * 9 // 5)
        self.chunks = _Cache(self.chunk, cached_words)
        self.is_special = regex.compile("(" + "|".join(map(regex.escape, bpe.special)) + ")") if bpe.special else None

    def chunk(self, chunk: str) -> bytes:
        text = (chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ")).lower()
        # Letters alone, or with one mark at the end, are what the word pattern would find.
        if text.isalpha():
            return self.pieces[text]
        if text[-1] in ".,;:!?" and text[:-1].isalpha():
            return self.pieces[text[:-1]] + self.pieces[text[-1]]
        return b"".join(map(self.pieces.__getitem__, self.bpe.words(text)))

    def plain(self, text: str) -> bytes:
        chunks = filter(None, self.space.split(text)) if self.odd_space.search(text) else text.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.is_special and "<|" in text and self.is_special.search(text):
            parts = self.is_special.split(text)
            return b"".join(
                np.array([self.bpe.special[p]], "<u4").tobytes() if p in self.bpe.special else self.plain(p) for p in parts
            )
        return self.plain(text)


_loaded: dict = {}


def text_encoder(path: str, engine: str, cached_words: int = 120_000) -> TextEncoder:
    """The worker's own encoder, kept between tasks.

    engine "segment_tree" merges here; "library" asks the tokenizers library for each word.
    """
    key = (path, engine, cached_words)
    if key not in _loaded:
        bpe = SegmentTreeBpe(path)
        if engine == "library":
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path).model
            merge = lambda piece: [t.id for t in model.tokenize(bpe.spelled(piece))]
        else:
            merge = bpe.merge
        _loaded[key] = TextEncoder(bpe, merge, cached_words)
    return _loaded[key]


def slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `most` bytes by `sizes`, so that long texts don't pile up in one output batch."""
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)


def text_sizes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    names, arrays = list(batch.schema.names), list(batch.columns)
    if name in names:
        arrays[names.index(name)] = values
    else:
        names, arrays = [*names, name], [*arrays, values]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    fields = [T.StructField(name, kind) if f.name == name else f for f in df.schema.fields]
    return T.StructType(fields if name in df.columns else [*fields, T.StructField(name, kind)])


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """`docs` plus `ids_col` (array<int>): the ids of each whole text; null and empty texts give [].

    Special tokens spelled out in a text are encoded as such.  A column of the name
    `ids_col` is replaced; all others pass unchanged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer_path, "segment_tree")
        for whole in batches:
            for batch in slices(whole, text_sizes(whole.column(text_col))):
                ids = [encoder.encode(t) for t in batch.column(text_col).to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                yield _with_column(batch, ids_col, pa.ListArray.from_arrays(pa.array(offsets), values))

    return docs.mapInArrow(run, _schema_with(docs, ids_col, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """`encoded` plus `text_col`: the tokens of `ids_col`, special ones included, joined as the library joins them.

    The vocabulary has no decoder, so tokens are separated by one space.  Null ids give "".
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = text_encoder(tokenizer_path, "segment_tree").bpe.tokens.__getitem__
        for whole in batches:
            lengths = pc.fill_null(pc.list_value_length(whole.column(ids_col)), 0).to_numpy(zero_copy_only=False)
            for batch in slices(whole, lengths * 8):
                column = batch.column(ids_col)
                texts = [" ".join(map(token, x.values.to_numpy().tolist())) if x.is_valid else "" for x in column]
                yield _with_column(batch, text_col, pa.array(texts, pa.string()))

    return encoded.mapInArrow(run, _schema_with(encoded, text_col, T.StringType()))
