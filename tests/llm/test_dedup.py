"""Exact, line and near-duplicate removal against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import duck, duck_rows, spark_rows
from conftest import SF
from tallyforge.llm import exact_dedup, jaccard_join, line_dedup, queries

SHAPE = "doc_id long, text string, kept string, bits int, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, "k") for i, t in rows], SHAPE).repartition(5)


@pytest.mark.parametrize("most_bits", [1 << 27, 1 << 15])
def test_exact(spark, most_bits):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (None, "z"), (6, "z"), (None, "n"), (7, "x" * 300_000)]
    got = sorted(((str(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(frame(spark, rows), most_bits=most_bits).collect()), key=str)
    assert got == sorted([
        ("1", 2, 3, False), ("2", 2, 3, True), ("2", 2, 3, True), ("3", 4, 2, False), ("4", 4, 2, True), ("5", 5, 1, True),
        ("None", 6, 2, False), ("6", 6, 2, True), ("None", None, 1, True), ("7", 7, 1, True),
    ], key=str)
    assert exact_dedup.exact_dedup(frame(spark, rows).limit(0)).count() == 0


def test_few_unique_rows_shuffle_however_small_the_filter(spark, monkeypatch):
    """Twenty thousand texts in eight slices of a filter of 4 KB each: under one in twenty unique rows is grouped."""
    shares, save = [], exact_dedup.Scratch.save

    def watched(self, df, name, *rest):
        out = save(self, df, name, *rest)
        if name == "marked":
            shares.append(out.agg(F.count_if("maybe"), F.count("*")).first())
        return out

    monkeypatch.setattr(exact_dedup.Scratch, "save", watched)
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.when(F.col("id") < 19_000, F.col("id")).otherwise(7).cast("string")).alias("text"))
    got = exact_dedup.exact_dedup(docs, most_bits=1 << 15)
    assert got.where("group_size = 1001 and keep_id = 19999").count() == 1001 and got.where("kept").count() == 19_000
    assert len(shares) == 8 and sum(n for _, n in shares) == 20_000
    assert 1001 <= sum(n for n, _ in shares) <= 1001 + 0.05 * 18_999


def test_exact_oracle(spark):
    assert spark_rows(queries.op9_exact_dedup(spark, SF)) == duck_rows(duck(SF), queries.ORACLE_SQL["op9_exact_dedup"])


def chunk_lines(spark, text):
    """Chunks of a text by the operator's own boundaries."""
    r = spark.createDataFrame([(text,)], "t string").select(line_dedup.chunks_of(line_dedup.hashed_lines(F.col("t"), 50), 2, 3).alias("c")).first()
    lines = text.split("\n")
    return [lines[c.start : c.start + c.length] for c in r.c]


def test_lines_against_brute_force(spark):
    rng = random.Random(2)
    block = [f"shared line {i} of a passage that repeats" for i in range(12)]
    rows = []
    for i in range(30):
        own = [f"own {i} {rng.random()}" for _ in range(rng.randint(0, 8))]
        at = rng.randint(0, len(own))
        rows.append((i, "\n".join(own[:at] + (block if i % 2 else []) + own[at:])))
    rows += [(100, None), (101, ""), (102, "\n\n\n\n"), (103, "\n\n\n\n"), (104, "one"), (105, "one"), (106, rows[3][1]), (107, "\n".join(["x", "y"] * 3000)), (None, rows[5][1])]
    got = defaultdict(list)
    for r in line_dedup.line_dedup(frame(spark, rows)).collect():
        got[r.doc_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    seen = set()
    for i, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        r = got[i][0]
        if text is None:
            assert (r.text, r.n_lines, r.n_removed_lines) == (None, 0, 0)
            continue
        left, removed = [], 0
        for c in chunk_lines(spark, text):
            body = "\n".join(c)
            if len(c) >= 2 and body.strip() and body in seen:
                removed += len(c)
            else:
                left += c
            if len(c) >= 2 and body.strip():
                seen.add(body)
        assert (r.text, r.n_removed_lines) == ("\n".join(left), removed), i
        assert (r.kept, r.bits, r.key) == ("c", 1, "k")
    assert line_dedup.line_dedup(frame(spark, rows).limit(0)).count() == 0


def passages_left(rows):
    """Texts less every line of a run that occurred before, by trying all runs; (text, removed lines) in the order of `rows`."""
    out, earlier = [], []
    for _, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0)):
        lines = text.split("\n")
        gone, n = set(), len(lines)
        for i in range(n):
            for k in range(1, n - i + 1):
                run = lines[i : i + k]
                if not any(map(str.strip, run)) or k == 1 and len(run[0].split()) <= 50:
                    continue
                here = any(lines[j : j + k] == run for j in range(i - k + 1))
                if here or any(old[j : j + k] == run for old in earlier if not n == len(old) == 1 for j in range(len(old) - k + 1)):
                    gone |= set(range(i, i + k))
        earlier.append(lines)
        out.append(("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    return out


def test_passages_against_all_runs(spark):
    rng = random.Random(5)
    blocks = [[f"passage {b} line {i} shared" for i in range(b)] for b in range(1, 7)] + [["long " * 30 + "and more " * 15], ["first part", "", "second part"]]
    rows = []
    for i in range(40):
        text = [f"own {i} {rng.random()}" for _ in range(rng.randint(1, 3))]
        for _ in range(rng.randint(1, 3)):
            text += rng.choice(blocks) + [f"own {i} {rng.random()}" for _ in range(rng.randint(0, 2))]
        rows.append((i, "\n".join(text)))
    alone = " ".join(f"w{i}" for i in range(60))
    rows += [(100, alone), (101, alone), (102, "a\n" + alone + "\nb"), (103, "x\ny\nx\ny\nx"), (104, "z\nz\nz"), (105, "z\nz\nz\nz\nz"), (106, "\n\n"), (107, "\n\n"), (108, rows[3][1]), (None, rows[5][1])]
    got = {r.doc_id: (r.text, r.n_removed_lines) for r in line_dedup.passage_dedup(frame(spark, rows)).collect()}
    want = passages_left(rows)
    assert [got[i] for i, _ in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0))] == want
    assert sum(n for _, n in want) > 100 and got[101] == (alone, 0) and got[102] == ("a\nb", 1)


def test_passages_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "p\n\n \n\t\nq"), (4, "c\np\n\n \n\t\nq\nd"), (5, "\n".join(["x", "y"] * 3000)), (6, "e\nf"), (6, "e\nf")]
    got = {(r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in line_dedup.passage_dedup(frame(spark, rows)).collect()}
    assert got == {(1, None, 0, 0), (2, "", 1, 0), (3, rows[2][1], 5, 0), (4, "c\nd", 7, 5), (5, "x\ny", 6000, 5998), (6, "e\nf", 2, 0)}
    assert line_dedup.passage_dedup(frame(spark, rows).limit(0)).count() == 0


def test_query_cuts_passages(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").where("text is not null").collect()]
    seen, want = set(), {}
    for i, text in sorted(rows):
        lines, gone = text.split("\n"), set()
        spans = [(j, 2) for j in range(len(lines) - 1) if "".join(lines[j : j + 2]).strip()] + [(j, 1) for j, x in enumerate(lines) if len(x.split()) > 50 and len(lines) > 1]
        own = {}
        for j, k in spans:
            run = tuple(lines[j : j + k])
            if run in seen or own.setdefault(run, j) + k <= j:
                gone |= set(range(j, j + k))
        seen |= set(own) | {tuple(lines[j : j + k]) for j, k in spans}
        want[i] = len(gone)
    got = {r.doc_id: r.n_removed_lines for r in queries.op10_line_dedup(spark, SF).where("text is not null").collect()}
    assert got == want


def test_clashing_names_are_replaced(spark):
    df = frame(spark, [(1, "a\nb\nc"), (2, "a\nb\nd")]).withColumns({"n_lines": F.lit("x"), "n_removed_lines": F.lit(None).cast("int"), "hash": F.lit(1), "start": F.lit("s"), "lines": F.lit(2)})
    for op in (line_dedup.passage_dedup, line_dedup.line_dedup):
        out = op(df)
        assert len(set(out.columns)) == len(out.columns) == len(df.columns)
        assert {r.doc_id: (r.n_lines, r.hash, r.start, r.lines) for r in out.collect()} == {1: (3, 1, "s", 2), 2: (3, 1, "s", 2)}


def test_most_repeated_lines_go_with_their_chunks(spark):
    """Of the lines that a passage's copies lose, most lie in content-defined chunks that repeat; the rest are the ends of passages."""
    rng = random.Random(8)
    passage = [[f"passage {p} line {i} {rng.random()}" for i in range(30)] for p in range(5)]
    rows = []
    for i in range(60):
        own = lambda: [f"own {i} {rng.random()}" for _ in range(rng.randrange(1, 6))]  # noqa: B023, E731
        rows.append((i, "\n".join(own() + passage[i % 5] + own())))
    removed = {op: op(frame(spark, rows)).agg(F.sum("n_removed_lines")).first()[0] for op in (line_dedup.line_dedup, line_dedup.passage_dedup)}
    assert removed[line_dedup.passage_dedup] == 55 * 30
    assert 0.7 * 55 * 30 <= removed[line_dedup.line_dedup] < 55 * 30


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    n = min(n, len(w))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows, n, percent):
    sets = defaultdict(list)
    for i, t in rows:
        sets[shingles(t, n)].append(i)
    keys = [k for k in sets if k]
    up = list(range(len(keys)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(keys):
        for j in range(i):
            both = len(a & keys[j])
            if both and 100 * both >= percent * (len(a) + len(keys[j]) - both):
                up[find(i)] = find(j)
    low = defaultdict(list)
    for i, k in enumerate(keys):
        low[find(i)] += [x for x in sets[k] if x is not None]
    want = {x: (len(k), min(low[find(i)], default=None)) for i, k in enumerate(keys) for x in sets[k]}
    return want | {x: (0, x) for x in sets.get(frozenset(), [])}


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_near_duplicates_against_brute_force(spark, words, percent):
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 30))
    rows, i = [], 0
    for size in (1, 2, 3, 4, 9, 10, 11, 12, 20, 21, 40, 150, 400):
        for _ in range(3):
            base = [word() for _ in range(size)]
            for edits in (0, 0, 1, 1, 2, 3, 4, 6):
                t = list(base)
                for _ in range(min(edits, size)):
                    t[rng.randrange(len(t))] = word()
                if edits == 3:
                    t += [word()]
                rows.append((i, (" " if i % 2 else "\n\t ").join(t).upper() if i % 3 == 0 else " ".join(t)))
                i += 1
    hot = [word() for _ in range(160)]
    for k in range(150):  # one large group of near copies
        t = list(hot)
        for _ in range(k % 5):
            t[rng.randrange(160)] = word()
        rows.append((10_000 + k, " ".join(t)))
    rows += [(20_000, None), (20_001, ""), (20_002, " \n"), (None, "only null"), (20_003, "only null"), (20_004, "é É"), (20_005, "e f g h " * 9000), (20_006, "e f g h " * 9000 + "z")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame(spark, rows), words=words, percent=percent, block=32).collect()}
    assert got == brute(rows, words, percent)


def test_near_duplicates_of_nothing(spark):
    assert jaccard_join.near_duplicates(frame(spark, [(1, "a")]).limit(0)).count() == 0
    assert jaccard_join.near_duplicates(frame(spark, [(1, None)])).collect()[0].component_id == 1


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op7_jaccard_join(spark, SF).collect()}
    assert got == brute(rows, 3, 90)


def test_word_hashes_in_parts():
    data = np.frombuffer(("ab Cd  é\n" * 500).encode(), np.uint8)
    assert (jaccard_join.word_hashes(data, 64) == jaccard_join.word_hashes(data)).all()
    assert hashlib.sha256(jaccard_join.word_hashes(data).tobytes()).digest() == hashlib.sha256(jaccard_join.word_hashes(np.frombuffer(("AB cD  é\n" * 500).encode(), np.uint8)).tobytes()).digest()
