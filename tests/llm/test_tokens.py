"""BPE and packing against the library, with odd texts."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tallyforge.llm import bpe, packing

P = pytest.importorskip("public_tokenizers")
PATH = str(P.path("word_bpe_49k.json"))
TEXTS = [None, "", " \n\t", "Hello, wörld! don't 12 ½ İΣΑΣ <|endoftext|>x", "a\x1cb\x85c", "ab" * 30_000, "same", "same", "word " * 20_000, "日本語 😀 é é"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i if i else None, t, "x", [1]) for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string, decoded array<int>")


@pytest.mark.parametrize("engine", ["segment_tree", "library"])
def test_random_texts(library, engine):
    rng, encoder = random.Random(5), bpe.text_encoder(PATH, engine)
    pool = [*"abcdeéèÉßÇñİΣσABC' ''\t\n\x1c\x85\xa0　.,!?12３½你好😀é<|", "<|endoftext|>", "'ll", "'RE", "the "]
    for _ in range(1500):
        text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_cache_generations(library):
    encoder = bpe.TextEncoder(bpe.SegmentTreeBpe(PATH), bpe.SegmentTreeBpe(PATH).merge, 5)
    text = " ".join(f"word{i % 13}x" for i in range(200))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_encode_decode(spark, docs, library):
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(got) == len(TEXTS)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), PATH).count() == 0


def test_buckets_hold_one_length(spark, docs, tmp_path):
    packing.write_buckets(packing.pack(docs, PATH, longest=256), f"{tmp_path}/b")
    back = spark.read.parquet(f"{tmp_path}/b")
    assert {(r.bucket, r.length) for r in back.select("bucket", "length").distinct().collect()} <= {(k, 1 << k) for k in range(9)}
    assert back.count() == packing.pack(docs, PATH, longest=256).count()


def test_packing_covers_every_id_once(spark, docs, library):
    got = packing.pack(docs, PATH, longest=256).collect()
    assert len({r.sequence_id for r in got}) == len(got)
    assert all(r.length == 1 << r.bucket and r.length <= 256 and r.offset == 0 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(TEXTS):
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by[i or None], key=lambda r: r.start)
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        assert np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist() == want
        assert {r.doc_tokens for r in pieces} == {len(want)}
    assert packing.pack(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, PATH, longest=100)


def test_queries_on_whole_tables(spark, library):
    from conftest import SF
    from tallyforge.llm import queries

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {k: library.encode(t, add_special_tokens=False).ids for k, t in texts.items()}
    got = {r.doc_id: r for r in queries.op5_bpe(spark, SF).collect()}
    assert got.keys() == ids.keys()
    for k, r in got.items():
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids[k])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids[k], skip_special_tokens=False).encode()).hexdigest()
    for r in queries.op2_packing(spark, SF).collect():
        own = np.array([*ids[r.doc_id], 1], "<u4")
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())


def test_other_normalizers_are_refused(tmp_path):
    import json

    data = json.load(open(PATH, encoding="utf-8"))
    for change in ({"normalizer": None}, {"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps(data | change), encoding="utf-8")
        with pytest.raises(ValueError, match="another way"):
            bpe.SegmentTreeBpe(str(path))
