"""SimHash, conversation repair and spelling variants against brute force and SQL."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from compare import duck, duck_rows, spark_rows
from conftest import SF
from tallyforge.llm import conversation_repair as repair
from tallyforge.llm import queries, simhash, spelling


@pytest.mark.parametrize("key", ["op12_conversation_repair", "op13_spelling_variants"])
def test_oracle(spark, key):
    assert spark_rows(queries.QUERIES[key](spark, SF)) == duck_rows(duck(SF), queries.ORACLE_SQL[key])


# SimHash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=4):
    """{row number: smallest id} by comparing all fingerprints with all others."""
    fps = [plain_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    ids = {c: min((r[0] for r, k in zip(rows, comp, strict=True) if k == c and r[0] is not None), default=None) for c in set(comp)}
    return [(r[0], f"{f:016x}", ids[c]) for r, f, c in zip(rows, fps, comp, strict=True)]


def near_texts(rng, n):
    """Texts of which many have fingerprints a few bits apart."""
    base = [f"w{rng.randrange(50)}" for _ in range(400)]
    rows = []
    for i in range(n):
        words = list(base) if i % 3 else [f"v{rng.randrange(1000)}" for _ in range(rng.randrange(1, 40))]
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("most_cell", [32_768, 40])
def test_simhash_whole_query_and_odd_rows(spark, most_cell):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    odd = [
        (None, "a b c d e"), (None, None), (900_000, ""), (900_001, " \t\n"), (900_002, "A b c\vD"), (900_003, "a b c d"), (900_004, "É é x y z"),
        (900_004, "É é x y z"), (900_005, "one"), (900_006, "z" * 50_000), (900_007, "lorem ipsum dolor sit " * 80_000), (None, "only here and nowhere else"),
    ]
    rows = docs + odd + near_texts(random.Random(3), 120)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, component_id int").repartition(5)
    got = sorted(map(tuple, simhash.near_duplicates(df, most_cell=most_cell).collect()), key=str)
    assert got == sorted(plain_components(rows), key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    if most_cell > 1000:
        query = sorted(map(tuple, queries.op11_simhash(spark, SF).collect()))
        assert query == sorted(plain_components(docs))


def test_distance_of_points_is_a_lower_bound_and_near_points_share_a_cell():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(400):
        for bit in rng.choice(64, rng.integers(0, 9), replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)

    def counts(x):
        return np.stack([simhash.points(x) >> np.uint64(2 * s) & np.uint64(3) for s in range(32)]).astype(int)

    hamming = np.bitwise_count(a ^ b)
    assert (np.abs(counts(a) - counts(b)).sum(axis=0) <= hamming).all()
    for x, y, d in zip(a, b, hamming, strict=True):
        if d <= simhash.MOST_BITS_APART:
            assert set(simhash.cells(np.array([x]))[0].tolist()) & set(simhash.cells(np.array([y]))[0].tolist())


def test_a_group_of_close_fingerprints_gives_a_forest(spark):
    """3,000 fingerprints within four bits of each other: one link less than members per cell and batch, not all pairs."""
    rng = np.random.default_rng(1)
    fps = sorted({int(sum(1 << int(b) for b in rng.choice(64, 2, replace=False))) for _ in range(20_000)} | {0})
    table = np.array(fps, np.uint64)
    keys, rows = simhash.cells(table)
    order = np.argsort(keys, kind="stable")
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(keys[order]), pa.array(table[rows[order]].view(np.int64))], names=["cell", "fp"])
    links = [x for b in simhash._links_in_cells(4, blocks=False)(iter([batch])) for x in zip(b["a"].to_pylist(), b["b"].to_pylist(), strict=True)]
    assert len(links) == len(fps) - 1


# Conversation repair


def plain_repair(turns):
    """Cheapest (cost, audit) over all states, turn by turn."""
    at = {0: (0, "")}

    def with_inserts(found):
        for _ in range(2):
            for s, (cost, audit) in list(found.items()):
                label = (cost + 2, audit + "I")
                found[3 if s == 2 else 2] = min(found.get(3 if s == 2 else 2, label), label)
        return found

    at = with_inserts(at)
    for initial, must_go, extra in turns:
        new = {}
        for s, (cost, audit) in at.items():
            spoken, wanted = (3, "a") if s == 2 else (2, "u")
            steps = [(s, 3, "D")] if must_go else [(s, 3, "D"), (spoken, 2 + extra, "R")]
            if not must_go and (initial == wanted or initial == "s" and s == 0):
                steps.append((1 if initial == "s" else spoken, extra, "K"))
            for to, price, name in steps:
                new[to] = min(new.get(to, (cost + price, audit + name)), (cost + price, audit + name))
        at = with_inserts(new)
    return min(at[s] for s in (0, 3) if s in at)


def random_turns(rng, n, roles):
    out = []
    for _ in range(n):
        must_go = rng.random() < 0.2
        out.append((rng.choice(roles), must_go, 0 if must_go else int(rng.random() < 0.3)))
    return out


def test_search_proves_the_cheapest_edits_and_looks_at_few_nodes():
    rng = random.Random(4)
    for _ in range(3000):
        turns = random_turns(rng, rng.randrange(9), "suuaax")
        assert repair.cheapest(turns) == plain_repair(turns)
    for roles in ("suuaax", "s", "us", "sa", "x"):
        turns = random_turns(rng, 400, roles)
        assert repair.cheapest(turns) == plain_repair(turns)
    assert repair.cheapest([]) == (0, "") and repair.cheapest([("s", False, 0)]) == (3, "D")


TURNS = "conv_id long, turn long, role string, text string, audit string, n int"


def repairs(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], TURNS).repartition(3)
    return {r.conv_id: r for r in repair.repair(df, **sizes).collect()}


def test_repair_of_odd_rows(spark):
    rows = [
        (1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 5, "assistant", "Yes"),
        (2, None, None, None), (2, 3, "", "Odd."), (2, 3, "user", "Q?"), (2, 3, "user", "Q?"), (2, None, "tool", "T."),
        (None, 1, "user", "A."), (None, 1, "assistant", "B."), (None, 9, "user", "A."), (3, 7, "user", "\t\n"), (4, None, "user", "So."), (4, None, "assistant", "x" * 200_000 + "."),
    ]
    for sizes in ({}, {"most_turns": 1}, {"most_turns": 2, "most_chars": 10}):
        got = repairs(spark, rows, **sizes)
        assert [got[1][c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")] == [3, 0, 0, 1, 0, 1, "KKK"]
        assert got[1].repaired_sha256 == digest("system:Be brief.\nuser:Hi.\nassistant:Yes")
        # Order: role " ", role "tool" without a number; then "" and twice "user" at 3.
        assert [got[2][c] for c in ("gaps", "blank", "duplicate", "truncated")] == [0, 1, 1, 0]
        assert (got[2].cost, got[2].audit) == plain_repair([(" ", True, 0), ("t", False, 0), ("", False, 0), ("u", False, 0), ("u", True, 0)])
        # Ties of number go by role, so the assistant comes first; its text occurs once, the user's twice.
        assert (got[None].gaps, got[None].duplicate, got[None].illegal) == (7, 1, 1)
        assert (got[None].cost, got[None].audit) == plain_repair([("a", False, 0), ("u", False, 0), ("u", True, 0)])
        assert (got[3].cost, got[3].audit, got[3].repaired_sha256) == (3, "D", digest(""))
        assert (got[4].gaps, got[4].cost, got[4].audit) == (0, *plain_repair([("a", False, 0), ("u", False, 0)]))
    assert repairs(spark, []) == {}


def digest(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def test_long_conversations_in_segments_equal_whole_ones(spark):
    """A conversation of a third of all rows, cut into segments over several partitions, against the plain form."""
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(["a.", "b", " ", f"text {t}.", f"more {t}"]))
            for c, n in ((7, 700), *((100 + i, rng.randrange(1, 9)) for i in range(250))) for t in range(n)]
    got = repairs(spark, rows, most_turns=16)
    assert len(got) == 251
    for c in got:
        mine, seen, turns, lines = [r for r in rows if r[0] == c], set(), [], []
        for _, _, role, text in mine:
            must_go = not text.strip() or (role, text) in seen
            seen.add((role, text))
            turns.append((role[0], must_go, 0 if must_go else int(text[-1] != ".")))
        cost, audit = plain_repair(turns)
        lines = list(repair.repaired(audit, repair.START, [r[2] for r in mine], [r[3] for r in mine]))
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        assert (got[c].cost, got[c].audit, got[c].repaired_sha256) == (cost, audit, digest("\n".join(lines)))
        assert got[c].illegal == sum(a[2][0] + b[2][0] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))


def test_damage_keeps_every_conversation(spark):
    rows = [(i, t, None if t == 1 else "user", None if t == 2 else "Text. Yes!") for i in range(30) for t in range(3)] + [(None, None, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = repair.repair_damaged(df).collect()
    assert sorted((r.conv_id for r in got), key=str) == sorted([*range(30), None], key=str)
    empty = repair.repair_damaged(df.where("conv_id = 4 and turn = 99").unionByName(df.limit(0)))
    assert empty.count() == 0
    gone = df.where("false").unionByName(df.withColumn("turn", F.lit(None).cast("long")).where("conv_id is not null"))
    one = {r.conv_id: r for r in repair.repair_damaged(gone).collect()}
    nothing = [r for r in one.values() if r.audit == ""]
    assert nothing and all((r.cost, r.repaired_sha256) == (0, digest("")) for r in nothing)


# Spelling variants


def plain_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_list_scan_finds_all_pairs():
    rng = random.Random(2)
    for t in range(600):
        words = sorted({"".join(rng.choice("ab" if t % 2 else "abé") for _ in range(rng.randrange(7))) for _ in range(rng.randrange(40))})
        assert sorted(spelling.one_edit_apart(words)) == [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if plain_near(words[i], words[j])]


@pytest.mark.parametrize("most_bucket", [256, 2])
def test_variants_with_ties_and_odd_words(spark, most_bucket):
    rng = random.Random(6)
    n = {"".join(rng.choice("abc") for _ in range(rng.randrange(6))): rng.randrange(1, 40) for _ in range(150)}
    n |= {"": 5, "l" * 3000: 9, "l" * 2999: 3, "été": 4, "ete": 8, "été!": 2, "x\U0001f600y": 3, "xy": 7}
    rows = [(w, 1, "x") for w, k in n.items() for _ in range(k)] + [(None, 1, "x")] * 4
    df = spark.createDataFrame(rows, "word string, m int, bucket string").repartition(4)
    got = {r.word: r for r in spelling.group_variants(df, most_bucket=most_bucket).collect()}
    kept = {w: k for w, k in n.items() if k >= 3}
    form = {}
    for w, k in kept.items():
        near = [x for x in kept if plain_near(w, x)]
        best = min(near, key=lambda x: (-kept[x], x), default=None)
        form[w] = best if best is not None and kept[best] >= 2 * k else None
        assert (got[w].n, got[w].n_near, got[w].form, got[w].form_n) == (k, len(near), form[w], kept.get(form[w]))
    for w in kept:
        end = w
        while form[end] is not None:
            end = form[end]
        assert got[w].root == end
    assert set(got) == set(kept)
    assert spelling.group_variants(df.limit(0)).count() == 0


def test_damaged_words(spark):
    rows = [(1, "ÀB×c÷dE Abcd abcdé_ABCDEf1ghijkl"), (2, None), (3, ""), (None, "words words")]
    got = sorted(r.word for r in spelling.damaged_words(spark.createDataFrame(rows, "doc_id long, text string"), divisor=1 << 40).collect())
    assert got == sorted(["Àb×c÷de", "abcdé", "abcdef", "ghijkl", "words", "words"])
    assert all(len(r.word) == 5 for r in spelling.damaged_words(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string"), divisor=1).collect())
