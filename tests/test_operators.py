"""Operators on small literal frames: the model's quirks and edge cases."""

import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallyforge.functions import columns
from tallyforge.functions.columns import parse_datetime, parse_vote, pnl, safe_float, volume_tier
from tallyforge.operators import analysis, backtest, bronze, distinct, features, gold, intervals, selection, silver, tags
from tallyforge.sources import catalogs, scans, sinks
from tallyforge.streaming import jobs
from tallyforge.streaming.tables import KeyedTable


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_pnl_covers_both_sides(spark):
    df = spark.createDataFrame([("BUY", True), ("BUY", False), ("SELL", True), ("SELL", False), ("SELL", None)], "side string, won boolean")
    out = [r[0] for r in df.select(pnl("side", "won", F.lit(0.25), F.lit(4.0))).collect()]
    assert out == [3.0, -1.0, -3.0, 1.0, 0.0]


def test_votes_match_substrings(spark):
    df = spark.createDataFrame([(" yes",), ("NO",), ("not sure",), ("I know",), ("maybe",), (None,)], "r string")
    assert [r[0] for r in df.select(parse_vote("r")).collect()] == [True, False, False, False, None, None]


def test_consensus_yes_first_on_ties(spark):
    df = spark.createDataFrame([(1, 1, f"m{i}", v) for i, v in enumerate(["yes", "yes", "no", "no"])] + [(1, 2, "m0", "?")], "tag_id int, market_id int, model string, response string")
    got = {r.market_id: (r.consensus, r.reason) for r in tags.consensus(df).collect()}
    assert got == {1: (True, "majority"), 2: (None, "no_votes")}
    assert {r.market_id: r.reason for r in tags.consensus(df, unanimous=True).collect()}[1] == "no_consensus"


def test_volume_tier_bounds_are_mid(spark):
    df = spark.createDataFrame([(5e3,), (1e4,), (1e5,), (5e5,), (None,)], "v double")
    assert [r[0] for r in df.select(volume_tier("v")).collect()] == ["low", "mid", "mid", "high", None]


def test_datetimes_and_floats(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("2024-01-02",), ("soon",), (None,)], "x string")
    assert [r[0] for r in df.select(parse_datetime("x")).collect()] == [datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.datetime(2024, 1, 2), None, None]
    df = spark.createDataFrame([("1.5",), ("NaN",), ("x",), (None,)], "x string")
    assert [r[0] for r in df.select(safe_float("x")).collect()] == [1.5, None, None, None]


def test_price_payload_shapes(spark):
    raw = [
        '{"history":[{"t":1,"p":0.5}]}', '{"prices":[{"timestamp":2,"price":0.25}]}', '{"sample_prices":[{"ts":3,"p":0,"price":0.75}]}', "[[4,0.1]]",
        '[{"ts":5}]', "{}", "nonsense", None,
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "token_id int, raw_json string")
    assert rows(bronze.price_points(df)) == [(0, 1, 0.5), (1, 2, 0.25), (2, 3, 0.75), (3, 4, 0.1), (4, 5, 0.0)]


def test_adaptive_switch_is_permanent_from_next_chunk(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 1.04), (1, 2, 1.0, 1.05), (1, 3, 1.0, 1.0), (2, 1, 1.0, 9.0), (2, 2, 1.0, 1.0), (3, 1, 0.0, 9.0), (3, 2, 0.0, 1.0)], "market_id int, chunk int, lo double, hi double")
    volume = F.when(F.col("market_id") == 2, 5e5).otherwise(5e4)
    got = {(r.market_id, r.chunk): r.minute for r in bronze.adaptive_resolution(df, volume).collect()}
    assert got == {(1, 1): False, (1, 2): False, (1, 3): True, (2, 1): False, (2, 2): False, (3, 1): False, (3, 2): False}


def test_resolution_of_broken_json(spark):
    df = spark.createDataFrame(
        [(1, '["1","0"]', True), (2, '["0.4","0.6"]', True), (3, "oops", True), (4, '["1","0"]', False), (5, None, True)], "market_id int, outcome_prices string, closed boolean"
    ).withColumns({"outcomes": F.lit('["Yes","No"]'), "question": F.lit("q"), "category": F.lit("c")})
    assert {r.market_id: r.is_resolved for r in backtest.resolution(df).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_upsert_is_idempotent_and_numbers_on(spark):
    old = spark.createDataFrame([(1, "a", "x", True, 0), (5, "b", "y", True, 0)], "id long, k string, q string, active boolean, updated_at int")
    new = spark.createDataFrame([("b", None, None), ("d", "z", True), ("c", "w", False)], "k string, q string, active boolean")
    once = silver.upsert_dim(old, new, "k", "id", ["active"], F.lit(9))
    assert rows(once.drop("status"), "id") == [(1, "a", "x", True, 0), (5, "b", "y", None, 9), (6, "c", "w", False, 9), (7, "d", "z", True, 9)]
    again = silver.upsert_dim(once.drop("status"), new, "k", "id", ["active"], F.lit(9))
    assert rows(again.drop("status"), "id") == rows(once.drop("status"), "id")


def test_dense_numbering_over_many_partitions(spark):
    keys = spark.range(1000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("k"))
    got = silver.number_new(keys.repartition(7), "k", 10, "id", partitions=9)
    assert [r.id for r in got.orderBy("k").collect()] == list(range(11, 1011))


def test_merge_prefers_first_source(spark):
    shape = "condition_id string, question string, description string, end_ts int, volume double, active boolean, closed boolean, category string, start_ts int"
    a = spark.createDataFrame([("1", "qa", None, 1, 1.0, None, True, "", None)], shape)
    b = spark.createDataFrame([("1", "qb", "db", 2, 2.0, True, False, "cat", 7), ("2", "q2", "d2", 3, 3.0, True, False, "c2", 8)], shape)
    got = {r.condition_id: r for r in silver.merge_markets(a, b).collect()}
    assert (got["1"].question, got["1"].description, got["1"].category, got["1"].start_ts, got["1"].origin) == ("qa", None, "cat", 7, "both")
    assert (got["2"].question, got["2"].origin) == ("q2", "b")


def test_spacing_counts_from_last_accepted(spark):
    t = lambda h: datetime.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([(1, t(h), 0.5, 0.1, "peak") for h in (0, 4, 7, 10, 14)], "token_id int, bin timestamp_ntz, price double, magnitude double, kind string")
    assert [r.bin.hour for r in features.spaced(df, 6).orderBy("bin").collect()] == [0, 7, 14]


def test_asof_carries_over_days(spark):
    d = lambda day, h: datetime.datetime(2024, 1, day, h)
    p = spark.createDataFrame([(1, d(1, 5), 0.1, 1), (1, d(3, 5), 0.3, 2)], "token_id int, ts timestamp_ntz, price double, event_id int")
    t = spark.createDataFrame([(1, d(1, 4)), (1, d(1, 5)), (1, d(2, 1)), (1, d(3, 4)), (1, d(4, 0)), (2, d(1, 1))], "token_id int, ts timestamp_ntz")
    assert [r.asof_price for r in features.price_asof(t, p).orderBy("token_id", "ts").collect()] == [None, 0.1, 0.1, 0.1, 0.3, None]


def test_missing_dataset_is_empty(spark, tmp_path):
    schema = spark.range(1).schema
    assert scans.scan(spark, f"{tmp_path}/none", schema).count() == 0


def test_partitions_append_replace_and_prune(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "2024-01-01"), (2, "y", "2024-01-02")], "id int, extra string, dt string")
    schema = df.select("id", "dt").schema
    sinks.append_partitioned(df, f"{tmp_path}/d", schema)
    sinks.replace_partitions(spark.createDataFrame([(9, "2024-01-02")], schema), f"{tmp_path}/d")
    assert rows(scans.scan(spark, f"{tmp_path}/d", spark.read.parquet(f"{tmp_path}/d").schema).selectExpr("id", "cast(dt as string)")) == [(1, "2024-01-01"), (9, "2024-01-02")]
    plan = scans.scan(spark, f"{tmp_path}/d", spark.read.parquet(f"{tmp_path}/d").schema, where=F.col("dt") == F.lit("2024-01-01").cast("date"))
    assert "PartitionFilters: [isnotnull(dt" in plan._jdf.queryExecution().toString()


def test_user_sums_equal_overall(spark):
    from tallyforge.plans.backtest import bt
    from tallyforge.adapters import Lake
    from conftest import SF

    trades = bt(Lake(spark, SF))
    users, whole = backtest.summary(trades, "wallet"), backtest.summary(trades).first()
    total = users.agg(F.sum(F.col("total_pnl").cast("decimal(18,4)")).cast("double").alias("p"), F.sum("total_trades").alias("n")).first()
    assert (total.p, total.n) == (whole.total_pnl, whole.total_trades)


def test_stream_resumes_without_duplicates(spark, tmp_path):
    df = spark.range(10).withColumn("v", F.col("id") * 2)
    for lo in (0, 5, 5):
        if lo == 0 or not (tmp_path / "second").exists():
            df.where((F.col("id") >= lo) & (F.col("id") < lo + 5)).write.mode("append").parquet(f"{tmp_path}/in")
        if lo == 5:
            (tmp_path / "second").mkdir(exist_ok=True)
        jobs.append(jobs.source(spark, f"{tmp_path}/in", df.schema), f"{tmp_path}/out", f"{tmp_path}/check")
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/out").orderBy("id").collect()] == list(range(10))


def test_streamed_upsert_equals_batch(spark, tmp_path):
    df = spark.createDataFrame([(i % 3, i) for i in range(12)], "k int, v int")
    table = KeyedTable(spark, f"{tmp_path}/t", df.schema, ["k"], buckets=4)
    for half in (0, 1):
        df.where(f"v % 2 = {half}").write.mode("append").parquet(f"{tmp_path}/in")
        jobs.upsert_stream(jobs.source(spark, f"{tmp_path}/in", df.schema), table, f"{tmp_path}/c", jobs.newest_by(["k"], ["v"]))
    assert rows(table.read()) == [(0, 9), (1, 10), (2, 11)]


@pytest.mark.parametrize("files", [1, 1000])
def test_streams_do_not_depend_on_the_order_of_files(spark, tmp_path, monkeypatch, files):
    import os

    from tallyforge.plans import streams

    # Newest rows first: one file each, days apart; token 9 stands in the oldest file only.
    at = datetime.datetime(2024, 5, 5, 12)
    data = [[(7, at, 500.0, 1), (8, at, 1000.0, 2)], [(7, at - datetime.timedelta(days=3), 1500.0, 3), (7, at - datetime.timedelta(minutes=-5), 1.0, 4)], [(9, at - datetime.timedelta(days=9), 2000.0, 5), (8, at, 2500.0, 0)]]
    folder = tmp_path / "events.parquet"
    for k, part in enumerate(data):
        spark.createDataFrame(part, "user_id long, ts timestamp_ntz, value double, event_id long").coalesce(1).write.mode("append").parquet(str(folder))
        new = [p for p in folder.glob("part-*.parquet") if not p.name.startswith("part-k")]
        new[0].rename(folder / f"part-k{k}.parquet")
        for p in folder.glob(".*.crc"):
            p.unlink()
        os.utime(folder / f"part-k{k}.parquet", (1_700_000_000 + k * 60,) * 2)
    whole = streams.events

    class Tables:
        pass

    v = Tables()
    v.spark, v.sf_dir, v.events = spark, str(tmp_path), spark.read.parquet(str(folder))
    monkeypatch.setattr(streams, "events", lambda v: whole(v, files))
    hours = {(r.token_id, r.hour, r.price) for r in streams.stream_hourly_prices(v).collect()}
    assert hours == {(7, at, 1.0), (8, at, 5.0), (7, at - datetime.timedelta(days=3), 3.0), (9, at - datetime.timedelta(days=9), 4.0)}
    assert sorted(r.token_id for r in streams.stream_dedupe(v).collect()) == [7, 8, 9]
    # The row that is kept: the first by time, then by event.
    s = streams.events(v)
    table = KeyedTable(spark, f"{tmp_path}/kept", s.schema, ["token_id"], buckets=4)
    jobs.upsert_stream(s, table, f"{tmp_path}/progress", jobs.dedupe(["token_id"], ["ts", "event_id"]))
    assert sorted((r.token_id, r.event_id) for r in table.read().collect()) == [(7, 3), (8, 0), (9, 5)]


def test_equal_fills_get_ids_of_their_own(spark):
    at = datetime.datetime(2024, 1, 1, 12, 0, 0)
    fills = [("w", 1, "Yes", at, 0.5, s, "BUY", 9) for s in (3.0, 1.0, 1.0)] + [("w", 1, "Yes", at, 0.5, 3.0, "SELL", 9)]
    trades = spark.createDataFrame(fills, "wallet string, market_id long, outcome string, ts timestamp_ntz, price double, size double, side string, taker_id long")
    tokens = spark.createDataFrame([(1, "Yes", 2)], "market_id long, outcome string, token_id long")
    traders = spark.createDataFrame([("w", 5)], "wallet string, trader_id long")
    got = silver.trade_fact(trades, tokens, traders).collect()
    assert len(got) == len({r.trade_id for r in got}) == 4
    again = silver.trade_fact(trades.repartition(3), tokens, traders).collect()
    assert {(r.trade_id, r.size) for r in got} == {(r.trade_id, r.size) for r in again}


def test_a_repeated_vote_counts_once(spark):
    votes = [(1, 1, "m1", "yes"), (1, 1, "m1", "Yes!"), (1, 1, "m2", "no"), (1, 2, "m1", "yes"), (1, 2, "m1", "no"), (1, 2, "m2", "no"), (1, 3, "m1", None)]
    df = spark.createDataFrame(votes, "tag_id int, market_id int, model string, response string")
    got = {r.market_id: (r.yes, r.no, r.consensus, r.judge_votes) for r in tags.consensus(df).collect()}
    assert got[1] == (1, 1, None, {"m1": True, "m2": False})
    assert got[2] == (0, 1, False, {"m1": None, "m2": False})
    assert got[3] == (0, 0, None, {"m1": None})


def test_next_markets_make_no_pair_product(spark):
    markets = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(0, 400, 2)] + [(7, "a")], "market_id long, category string")
    tag = spark.createDataFrame([(1, True, False, 11), (2, True, False, -5), (3, True, False, 398), (4, False, False, 0), (5, True, True, 0), (6, True, False, 11)], "tag_id int, is_active boolean, all_checked boolean, last_checked int")
    pair = "tag_id int, market_id long"
    known = spark.createDataFrame([(1, i) for i in range(12, 60, 2)] + [(2, 0), (2, 7), (6, 5000)], pair)
    none = spark.createDataFrame([], pair)
    out = tags.markets_for_tagging(tag, markets, known, none, none, n=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and plan.count("BroadcastNestedLoopJoin") <= 1  # the one-row number of cursors
    assert rows(out, "tag_id", "position") == [(1, 60, 1), (1, 62, 2), (1, 64, 3), (2, 2, 1), (2, 4, 2), (2, 6, 3), (6, 12, 1), (6, 14, 2), (6, 16, 3)]
    only = tags.markets_for_tagging(tag, markets, known, none, none, n=3, categories=["a"])
    assert rows(only, "tag_id") == []


def test_numbering_leaves_nothing_cached(spark):
    df = spark.createDataFrame([(f"k{i}",) for i in range(50)], "k string")
    ids = silver.number_new(df, "k", 10, "id", partitions=4)
    assert [r.id for r in ids.orderBy("k").collect()] == list(range(11, 61)) == [r.id for r in ids.orderBy("k").collect()]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_floor_grows_by_page(spark):
    sizes = {0: [1.0, 2.0], 1: [1.0], 2: [3.9, 3.5, 1.0], 3: [3.0, 3.5, 9.0], 4: [10.2], 5: [12.0, 13.5], 6: [20.0]}
    df = spark.createDataFrame([(1, p, s) for p, page in sizes.items() for s in page], "market_id int, page int, size double")
    got = rows(bronze.growing_floor(df).select("page", "size", "floor"))
    assert got == [(0, 1.0, 0.0), (0, 2.0, 0.0), (1, 1.0, 0.0), (2, 1.0, 0.0), (2, 3.5, 0.0), (2, 3.9, 0.0), (3, 3.5, 3.0), (3, 9.0, 3.0), (4, 10.2, 3.0), (5, 13.5, 13.0), (6, 20.0, 13.0)]


def test_only_the_middle_tier_switches(spark, tmp_path):
    prices = [(m, v, p) for m, v in ((1, 5e3), (2, 5e4), (3, 5e5), (4, 1e4), (5, 1e5)) for p in (1.0, 1.05)] + [(6, 5e4, 1.0), (6, 5e4, 1.049), (7, 5e4, 0.0), (7, 5e4, 1.0)]
    schema = "market_id long, volume double, price double"
    spark.createDataFrame(prices, schema).write.parquet(f"{tmp_path}/in")
    s = jobs.adaptive_switch(jobs.source(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema))
    table = KeyedTable(spark, f"{tmp_path}/out", s.schema, ["market_id"], buckets=4)
    jobs.upsert_stream(s, table, f"{tmp_path}/check", lambda old, new: new.unionByName(old.join(new, "market_id", "left_anti")), mode="update")
    assert {r.market_id: r.minute for r in table.read().collect()} == {1: False, 2: True, 3: False, 4: True, 5: True, 6: False, 7: False}


def test_a_load_stops_at_a_failed_blocking_step(spark):
    from tallyforge.operators.load import Step, run_steps

    bad = lambda t: spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    good = lambda t: spark.range(3)
    tables, results = run_steps([Step("a", good, True), Step("b", bad, False), Step("c", lambda t: t["a"].where("id > 0"), True), Step("d", bad, True), Step("e", good, False)])
    assert [(r.name, r.status) for r in results] == [("a", "loaded"), ("b", "failed"), ("c", "loaded"), ("d", "failed"), ("e", "skipped")]
    assert tables["c"].count() == 2 and "no" in results[1].error and set(tables) == {"a", "c"}


def test_feature_names_are_the_columns(spark):
    from conftest import SF
    from tallyforge.adapters import Lake

    v = Lake(spark, SF)
    assert features.market_features(v.markets, v.market_tokens, v.trades).columns == features.MARKET_COLUMNS
    assert features.trader_features(v.traders, v.trades).columns == features.TRADER_COLUMNS
    assert features.price_features(v.prices, v.market_tokens).columns == features.PRICE_COLUMNS
    names = [r.name for r in features.available_tags(v.tags).collect()]
    one_hot = features.tag_one_hot(v.markets, v.market_tags, v.tags, names)
    assert names == sorted(names) and set(one_hot.columns) == {"market_id", "tag_count", *(f"tag_{n}" for n in names)}


def test_cursors_and_categories(spark):
    from tallyforge.functions.columns import decode_cursor, encode_cursor

    df = spark.createDataFrame([(0,), (1000,), (62,), (None,)], "n long")
    assert [tuple(r) for r in df.select(encode_cursor("n").alias("c")).select("c", decode_cursor("c")).collect()] == [("MA==", 0), ("MTAwMA==", 1000), ("NjI=", 62), (None, None)]
    df = spark.createDataFrame([('["a","b"]',), (None,), ("",), ("[bad",), ("7",), ('{"a":1}',)], "categories string")
    assert [r.categories for r in tags.tag_categories(df).collect()] == [["a", "b"], [], [], [], [], []]


def test_money_sums_round_nothing_away(spark):
    small = spark.range(100_000).select(F.lit(0.00004).alias("x"))
    assert small.agg(columns.money_sum("x")).first()[0] == 4.0
    values = [0.1, 1e9, -1e9, 0.07 * 13, 123456.654321, 0.2] * 50
    df = spark.createDataFrame([(x,) for x in values], "x double").repartition(7)
    assert df.agg(columns.money_sum("x")).first()[0] == math.fsum(values)
    flat = spark.range(1000).select((F.lit(1e9) + F.col("id") % 2).alias("x"))
    assert abs(flat.agg(columns.stddev("x")).first()[0] - statistics.stdev(i % 2 for i in range(1000))) < 1e-7
    assert flat.limit(1).agg(columns.stddev("x")).first()[0] is None


def test_overlapping_spans_against_all_pairs(spark):
    rng = random.Random(1)
    day = datetime.datetime(2024, 1, 1)

    def some(n):
        out = []
        for i in range(n):
            a = day + datetime.timedelta(seconds=rng.randrange(40 * 86_400))
            out.append((rng.randrange(3), i, a, a + datetime.timedelta(seconds=rng.choice([0, 1, 3600, 86_400, 20 * 86_400, -5, 900 * 86_400]))))
        return out + [(1, n, None, day), (2, n + 1, day, None), (None, n + 2, day, day)]

    left, right = some(120), some(120)
    a = spark.createDataFrame(left, "k int, i int, s timestamp_ntz, e timestamp_ntz")
    b = spark.createDataFrame(right, "k int, j int, s2 timestamp_ntz, e2 timestamp_ntz")
    out = intervals.overlapping(a, b, ["k"], ("s", "e"), ("s2", "e2"), cell_seconds=600)
    want = sorted((x[1], y[1]) for x in left for y in right if x[0] is not None and x[0] == y[0] and None not in (*x, *y) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and x[3] >= y[2])
    assert sorted((r.i, r.j) for r in out.collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.overlapping(a.limit(0), b, ["k"], ("s", "e"), ("s2", "e2")).count() == 0


def test_spacing_by_jumps_equals_the_greedy_scan(spark):
    rng = random.Random(2)
    day = datetime.datetime(2024, 1, 1)
    rows = [(t, day + datetime.timedelta(hours=h), 0.5, 0.1, "peak") for t in range(5) for h in sorted(rng.sample(range(400), rng.randrange(1, 200)))]
    df = spark.createDataFrame(rows, "token_id long, bin timestamp_ntz, price double, magnitude double, kind string")
    want, last = [], {}
    for t, at, *_ in rows:
        if t not in last or at - last[t] >= datetime.timedelta(hours=6):
            want.append((t, at))
            last[t] = at
    got = features.spaced(df)
    assert sorted((r.token_id, r.bin) for r in got.collect()) == sorted(want)
    assert features.spaced(df.limit(0)).count() == 0


def test_attached_tables_are_read_by_name_and_never_written(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/numbers")
    catalogs.attach(spark, "other_lake", {"numbers": f"{tmp_path}/numbers"})
    assert spark.sql("SELECT count(*) FROM other_lake.numbers WHERE id > 1").first()[0] == 3
    with pytest.raises(Exception, match="VIEW|view"):
        spark.sql("INSERT INTO other_lake.numbers VALUES (9)")
    with pytest.raises(ValueError):
        catalogs.attach(spark, "a; DROP", {})
    catalogs.detach(spark, "other_lake")
    assert spark.range(1).count() and not spark.catalog.databaseExists("other_lake")


def test_second_decisions_are_corrections_and_set_the_time(spark):
    at = lambda h: datetime.datetime(2024, 1, 1, h)
    history = spark.createDataFrame(
        [(1, 1, None, "judges", at(0)), (1, 2, True, "human", at(0)), (1, 3, None, "judges", at(0)), (1, 4, None, "judges", None)],
        "tag_id int, market_id int, human_decision boolean, decided_by string, updated_at timestamp_ntz",
    )
    decisions = spark.createDataFrame(
        [(1, 1, True, at(5)), (1, 2, False, at(4)), (1, 4, False, at(6)), (1, 4, True, at(7)), (1, 3, None, at(9))],
        "tag_id int, market_id int, decision boolean, decided_at timestamp_ntz",
    )
    got = {r.market_id: (r.human_decision, r.decided_by, r.updated_at) for r in tags.human_overrides(history, decisions).collect()}
    assert got == {1: (True, "human", at(5)), 2: (False, "human_correction", at(4)), 3: (None, "judges", at(0)), 4: (True, "human_correction", at(7))}


def size_of(folder):
    return sum(p.stat().st_size for p in folder.rglob("*.parquet"))


def test_a_batch_rewrites_the_buckets_it_touches(spark, tmp_path):
    """Of a hundred buckets a batch of one key writes one: about a hundredth of the bytes."""
    df = spark.range(40_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(0).alias("n"))
    table = KeyedTable(spark, f"{tmp_path}/t", df.schema, ["k"], buckets=100)
    newest = jobs.newest_by(["k"], ["n"])
    table.merge(df, 0, newest)
    table.merge(df.where("k = 77").withColumn("n", F.lit(5)), 1, newest)
    assert 0 < size_of(tmp_path / "t/data/v1") < 0.02 * size_of(tmp_path / "t/data/v0")
    assert table.read().count() == 40_000 and table.read().where("n = 5").count() == 1 and table.read(below=1).where("n = 5").count() == 0
    looked_up = table.lookup(spark.createDataFrame([(77,), (78,), (10**9,)], "k long"))
    assert sorted((r.k, r.n) for r in looked_up.collect()) == [(77, 5), (78, 0)] and len(looked_up.inputFiles()) <= 3
    # The old copy of the bucket goes once no kept version reads it; all else stays.
    assert table.vacuum(keep=2) == []
    assert [g.split("/")[0] for g in table.vacuum(keep=1)] == ["v0"] and table.versions() == [1] and table.read().count() == 40_000
    empty = KeyedTable(spark, f"{tmp_path}/none", df.schema, ["k"])
    assert empty.read().count() == 0 and empty.vacuum() == []
    empty.merge(df.limit(0), 0, newest)
    assert empty.read().count() == 0 and empty.versions() == [0]


@pytest.mark.parametrize("where", ["data", "manifest", "after"])
def test_a_run_cut_off_inside_a_batch_is_resumed(spark, tmp_path, monkeypatch, where):
    """Stopped when the second batch's data are written, before its manifest, or when it is committed but not noted: nothing is lost or counted twice."""
    df = spark.createDataFrame([(i % 5, 1, i) for i in range(60)], "k int, n int, i int")
    table = KeyedTable(spark, f"{tmp_path}/t", spark.createDataFrame([], "k int, n long").schema, ["k"], buckets=3)
    add = lambda old, new: old.unionByName(new.groupBy("k").agg(F.count("*").alias("n"))).groupBy("k").agg(F.sum("n").alias("n"))

    def run():
        jobs.upsert_stream(jobs.source(spark, f"{tmp_path}/in", df.schema), table, f"{tmp_path}/c", add)

    df.where("i < 20").write.parquet(f"{tmp_path}/in")
    run()
    df.where("i >= 20").write.mode("append").parquet(f"{tmp_path}/in")
    commit = KeyedTable._commit

    def broken(self, n, manifest):
        if where == "manifest":
            _, fs = self._fs(self.root)
            fs.create(self._fs(f"{self.root}/manifest/{n}.draft")[0], True).close()
        if where == "after":
            commit(self, n, manifest)
        raise RuntimeError("cut off")

    monkeypatch.setattr(KeyedTable, "_commit", broken)
    with pytest.raises(Exception, match="cut off"):
        run()
    assert sorted(map(tuple, table.read(below=1).collect())) == [(k, 4) for k in range(5)]
    assert table.read().agg(F.sum("n")).first()[0] == (60 if where == "after" else 20)  # whole versions only
    monkeypatch.setattr(KeyedTable, "_commit", commit)
    run()
    run()
    assert sorted(map(tuple, table.read().collect())) == [(k, 12) for k in range(5)]


def test_sessions_leave_the_state_and_late_rows_are_told(spark, tmp_path):
    """Ten batches of a day each, with rows that come days late: the state never holds more than the open sessions."""
    day = datetime.datetime(2024, 1, 1)
    marks = KeyedTable(spark, f"{tmp_path}/marks", jobs.MARK, ["batch"], buckets=4)
    dropped, state, n = 0, [], 0
    for d in range(10):
        data = [(k, day + datetime.timedelta(days=d, hours=h)) for k in range(20) for h in (1, 2, 9, 20)]
        data += [(k, day + datetime.timedelta(days=d - 3)) for k in range(d)]  # too late from the second batch on
        n += len(data)
        df = spark.createDataFrame(data, "k int, ts timestamp")
        df.write.mode("append").parquet(f"{tmp_path}/in")
        stream = lambda: jobs.source(spark, f"{tmp_path}/in", df.schema)  # noqa: B023, E731
        for p in jobs.session_stream(stream(), "k", f"{tmp_path}/out", f"{tmp_path}/c1"):
            dropped += sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"])
            state.append(max((o["numRowsTotal"] for o in p["stateOperators"]), default=0))
        jobs.late_rows(stream(), f"{tmp_path}/late", marks, f"{tmp_path}/c2")
    late = spark.read.schema(df.schema).parquet(f"{tmp_path}/late/batch=*")
    ended = spark.read.schema("k int, start timestamp, end timestamp, n long").parquet(f"{tmp_path}/out")
    assert late.count() == dropped == sum(range(10)) > 0
    assert max(state) <= 80  # three sessions a key and day, of which all but the last of a day end within it
    assert ended.agg(F.sum("n")).first()[0] + late.count() == n - 20  # the last hour's sessions are open


@pytest.mark.parametrize("most", [4096, 50])
def test_order_statistics_by_narrowing(spark, most):
    """Groups of equal, skewed, few and very spread values; with a bound of fifty most go through the sketch."""
    rng = random.Random(3)
    groups = {
        1: [5.0] * 400, 2: [rng.random() for _ in range(501)], 3: [1.0] * 300 + [2.0] * 301 + [9.0], 4: [math.exp(rng.uniform(-700, 700)) for _ in range(600)], 5: [3.0],
        6: [1.0, 2.0], 7: [-1.0] * 5 + [float(i) for i in range(300)], 8: [0.0] * 299 + [1.0] * 299, None: [4.0, 4.0, 6.0, 8.0],
    }
    data = [(k, v, "x") for k, vs in groups.items() for v in vs] + [(5, None, "x"), (9, None, "x"), (6, float("nan"), "x")]
    df = spark.createDataFrame(data, "k int, v double, n string").repartition(5)
    got = {r.k: (r.n, r.nth) for r in selection.nth_values(df, ["k"], F.col("v"), lambda n: F.floor(n / 2), most).collect()}
    assert got == {k: (len(vs), sorted(vs)[len(vs) // 2]) for k, vs in groups.items()}
    if most > 1000:
        assert {r.k: r.median for r in selection.median(df, ["k"], F.col("v")).collect()} == {k: statistics.median(vs) for k, vs in groups.items()}
    assert selection.median(df.limit(0), ["k"], F.col("v")).count() == 0


def test_a_rebuilt_table_takes_its_dependents_along():
    assert gold.dependents("markets") == {"tokens", "prices", "trades"} and gold.dependents("categories") == {"events", "markets", "tokens", "prices", "trades"}
    assert gold.dependents("trades") == set() and gold.dependents("traders") == {"trades"}


def test_distinct_counts_roll_up(spark):
    """More members than one bitmap holds, in two groups that overlap."""
    df = spark.range(50_000).select(F.explode(F.array(F.col("id"), F.col("id"))).alias("who"), (F.col("id") % 2).alias("g"))
    df = df.unionByName(spark.range(10).select(F.col("id").alias("who"), F.lit(7).cast("long").alias("g"))).unionByName(df.limit(1).select(F.lit(None).cast("long").alias("who"), "g"))
    bits = distinct.member_bits(df, ["g"], "who")
    assert bits.count() <= 6
    assert {r.g: r.n for r in distinct.members(bits, {"g": F.col("g")}).collect()} == {0: 25_000, 1: 25_000, 7: 10}
    assert [r.n for r in distinct.members(bits, {}).collect()] == [50_000]


def test_repeats_touch_the_days_they_belong_to(spark, tmp_path):
    """Thirty days of fills; a batch of one new day and one late repeat rewrites those two days' buckets and leaves the rest."""
    day = datetime.datetime(2024, 1, 1)
    shape = "day date, wallet string, ts timestamp_ntz, size double"
    fills = [((day + datetime.timedelta(days=d)).date(), f"w{k}", day + datetime.timedelta(days=d, seconds=k), 1.0) for d in range(30) for k in range(20)]
    df = spark.createDataFrame(fills, shape)
    table = KeyedTable(spark, f"{tmp_path}/t", df.schema, ["day"], buckets=512)
    first = jobs.dedupe(["day", "wallet", "ts"], ["size"])
    table.merge(df, 0, first)
    late = [(*fills[3][:3], 9.0), (*fills[3][:3], 0.5), ((day + datetime.timedelta(days=40)).date(), "w", day + datetime.timedelta(days=40), 1.0)]
    table.merge(spark.createDataFrame(late, shape), 1, first)
    assert table.read().count() == 601 and table.read().where("size = 0.5").count() == 1
    assert len(list((tmp_path / "t/data/v1").glob("bucket=*"))) == 2


def test_staged_documents_are_parsed_once(spark):
    docs = ['{"maker": "0x01", "taker": null, "price": "0.5", "size": 2, "side": "buy", "outcome": "Yes", "timestamp": "1700000000"}', "no json", None, '{"price": 0.25, "side": 1, "outcome": "No"}']
    staged = spark.createDataFrame([(f"c{i}", d) for i, d in enumerate(docs)], "condition_id string, raw_json string")
    markets = spark.createDataFrame([(7 + i, f"c{i}") for i in range(4)], "market_id long, external_id string")
    tokens = spark.createDataFrame([(m, yes, m * 10 + yes) for m in range(7, 11) for yes in (True, False)], "market_id long, is_yes boolean, token_id long")
    out = gold.trade_fact(staged, markets, tokens, spark.createDataFrame([], gold.TRADER_DIM))
    assert sorted((r.token_id, r.price, r.size, r.is_buy) for r in out.collect()) == [(71, 0.5, 2.0, True), (100, 0.25, None, False)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") + plan.lower().count("parsejson") == 1, plan


def test_sketched_counts_of_small_groups_are_exact(spark):
    """6,000 groups of 12 to 19 members; a sketch of 2^12 registers is two off in some of them."""
    df = spark.range(6_000 * 20).select(F.floor(F.col("id") / 20).alias("g"), F.col("id").alias("who")).where("who % 20 < 12 + g % 8")
    out = distinct.sketched(df.unionByName(df).unionByName(spark.range(3).select(F.col("id").alias("g"), F.lit(None).cast("long").alias("who"))), ["g"], "who")
    assert out.count() == 6_000 and out.where("exact <> 12 + g % 8 or about <> exact").count() == 0
    assert abs(distinct.sketched(spark.range(100_000).selectExpr("1 AS g", "id AS who"), ["g"], "who").first().about - 100_000) < 5_000


def test_first_appearances_add_up(spark):
    """Repeats on a day, over days, over months and over years; null days, keys and members."""
    rnd = random.Random(5)
    day = lambda: rnd.choice([None, *[datetime.date(2023 + n // 6, 1 + n % 6, 1 + n % 3) for n in range(12)]])
    data = [(rnd.choice([None, 1, 2]), day(), rnd.choice([None, *"abcdefgh"])) for _ in range(300)]
    df = spark.createDataFrame(data, "k long, day date, who string")
    days = distinct.first_seen(df, "k", "day", "who", {"month": F.trunc("day", "month"), "all": F.lit(True)})
    assert days.count() <= len({(k, d) for k, d, w in data if w})

    def want(level):
        out = {}
        for k, d, w in data:
            if w:
                out.setdefault((k, level(d)), set()).add(w)
        return {key: len(x) for key, x in out.items()}

    month = lambda d: d and d.replace(day=1)
    assert {(r.k, r.day): r.n for r in days.collect()} == want(lambda d: d)
    assert {(r.k, r.m): r.n for r in days.groupBy("k", F.trunc("day", "month").alias("m")).agg(F.sum("month").alias("n")).collect()} == want(month)
    assert {(r.k, None): r.n for r in days.groupBy("k").agg(F.sum("all").alias("n")).collect()} == want(lambda d: None)


def parses(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    return plan.count("parse_json") + plan.count("parsejson")


def staged_trades(spark):
    a, b = "0x" + "ab" * 20, "0x" + "cd" * 20
    docs = [
        f'{{"maker": "{a}", "taker": "{b}", "price": 0.5, "size": 1, "side": "BUY", "outcome": "yes", "timestamp": 1}}', f'{{"maker": "{b}", "taker": "0x12", "price": 0.5, "size": 2, "outcome": "maybe", "timestamp": 2}}',
        f'{{"maker": "{a}", "taker": "xx{"ef" * 20}", "size": 3, "outcome": "no"}}', f'{{"maker": "{a}", "price": 0.25, "outcome": "no", "timestamp": 3}}',
    ]
    return spark.createDataFrame([("c1", d) for d in docs], "condition_id string, raw_json string")


def test_both_wallets_of_a_trade_come_from_one_parse(spark):
    staged = staged_trades(spark)
    have = spark.createDataFrame([(7, bytes.fromhex("cd" * 20))], gold.TRADER_DIM)
    both = gold.trade_rows(staged)
    assert parses(gold.traders(staged.select(F.try_parse_json("raw_json").cast("string").alias("maker"), F.lit(None).cast("string").alias("taker")), have)) == 1
    assert parses(both) == 1
    dim = gold.trader_dim(staged, have)
    assert rows(dim) == rows(gold.trader_dim(both, have)) == [(7, bytearray.fromhex("cd" * 20)), (8, bytearray.fromhex("ab" * 20))]
    markets = spark.createDataFrame([(1, "c1")], "market_id long, external_id string")
    tokens = spark.createDataFrame([(1, True, 10), (1, False, 11), (1, None, 12)], "market_id long, is_yes boolean, token_id long")
    want = [(10, 1.0, True, 8, 7), (10, 2.0, False, 7, None), (11, None, False, 8, None), (11, 2.0, False, 7, None)]
    for trades in (staged, both, gold.with_traders(both, dim)):
        out = gold.trade_fact(trades, markets, tokens, dim).select("token_id", "size", "is_buy", "maker_id", "taker_id")
        assert sorted(rows(out), key=str) == sorted(want, key=str)


def test_two_runs_look_wallets_up_once(spark):
    trades = gold.StagedTrades(staged_trades(spark))
    dim = gold.trader_dim(trades.rows, spark.createDataFrame([], gold.TRADER_DIM))
    assert parses(trades.rows) == 0 and trades.known(dim) is trades.known(dim) and trades.known(dim).count() == 3
    assert trades.known(dim.limit(0)).where("maker_id is not null").count() == 0


def test_a_market_staged_twice_is_one_row_of_the_dimension(spark):
    doc = '{"question": "%s", "event": {"slug": "e%d"}, "startDate": "2024-01-01"}'
    staged = spark.createDataFrame([("c1", doc % ("old", 1), 1), ("c1", doc % ("new", 2), 2), ("c2", None, 1)], "condition_id string, raw_json string, fetched_at long")
    for docs in (staged, gold.market_rows(staged)):
        events = gold.events(docs, gold.categories(docs))
        assert rows(events.select("event_id", "slug", "title")) == [(1, "e1", "old"), (2, "e2", "new"), (3, "unknown-c2", "Untitled")]
        dim = gold.market_dim(docs, events, spark.createDataFrame([], gold.MARKET_DIM))
        assert rows(dim.select("market_id", "external_id", "event_id", "question")) == [(1, "c1", 2, "new"), (2, "c2", 3, "Unknown")]


def test_groups_of_a_market_travel_as_one_list(spark):
    """Several groups a market, one of them null, markets without any; trades are not multiplied before they are summed."""
    trades = spark.createDataFrame([(1, 5, m, 0.5, 2.0, float(p)) for m, p in [(1, 3), (1, 1), (2, -1), (3, 9)]], "trader_id long, taker_id long, market_id long, price double, size double, pnl double")
    groups = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, None)], "market_id long, tag string")
    out = features.top_groups(trades, groups, "tag", 2)
    want = [("a", 2, 2.0, 4.0, 1.0, 1), ("b", 3, 3.0, 3.0, 2 / 3, 2)]
    assert rows(out, "person", "rank") == [(who, *w) for who in ("m1", "t5") for w in want]
    assert rows(features.top_groups(trades, groups, "tag", 3).where("tag is null").select("person", "total_pnl", "rank")) == [("m1", -1.0, 3), ("t5", -1.0, 3)]
    # Groups are multiplied out above the first sum, not below it.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode(__groups") < plan.index("Aggregate [person", plan.index("Generate explode(__groups"))


def test_spacing_broadcasts_nothing(spark):
    at = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    out = features.spaced(spark.createDataFrame([(1, at(h)) for h in (0, 2, 7, 9, 13, 20)], "token_id long, bin timestamp_ntz"))
    assert [r.bin for r in out.orderBy("bin").collect()] == [at(h) for h in (0, 7, 13, 20)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_landed_rows_of_two_days_are_made_once(spark, monkeypatch):
    from conftest import SF
    from tallyforge.plans import lake
    from tallyforge.registry import QUERIES

    names, made = [], lake.written
    monkeypatch.setattr(lake, "written", lambda frame, name: names.append(name) or made(frame, name))
    assert QUERIES["bronze_market_tokens"](spark, SF).where("n <> 1").count() == 0
    assert names == ["landed"]


@pytest.fixture
def small_slices(monkeypatch):
    """Inputs of the smallest scale are cut as large ones are."""
    from tallyforge.sources import shared

    monkeypatch.setattr(shared, "SLICE", 8_000)
    monkeypatch.setattr(shared, "FEW", 2)


def same_as_oracle(spark, key):
    from compare import duck, duck_rows, spark_rows
    from conftest import SF
    from tallyforge.registry import ORACLE_SQL, QUERIES

    assert spark_rows(QUERIES[key](spark, SF)) == duck_rows(duck(SF), ORACLE_SQL[key])


def test_large_joins_are_cut_by_the_size_of_their_input(spark, small_slices):
    from conftest import SF
    from tallyforge.adapters import Lake
    from tallyforge.sources.shared import slices

    v = Lake(spark, SF)
    n = slices(v.lineitem, v.orders)
    plan = v.trades._jdf.queryExecution().optimizedPlan().toString()
    assert n > 4 and plan.count("RepartitionByExpression") == 2 and plan.count(f"], {n}") == 2
    same_as_oracle(spark, "bt_sources")


def test_people_of_markets_are_told_apart_in_slices(spark, small_slices):
    from conftest import SF
    from tallyforge.adapters import Lake

    v = Lake(spark, SF)
    plan = features.market_features(v.markets, v.market_tokens, v.trades)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [market_id" in plan and "concat(m" not in plan
    same_as_oracle(spark, "market_features")


def test_category_counts_multiply_no_row(spark, small_slices):
    trades = spark.createDataFrame(
        [(1, "a", 0.5, 2.0), (1, "a", 0.5, None), (1, "b", 0.25, 4.0), (2, None, 0.5, 2.0), (3, "a", 0.5, 6.0), (9, "z", 1.0, 1.0)], "market_id long, wallet string, price double, size double"
    )
    markets = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (1, "y")], "market_id long, category string")
    out = analysis.category_stats(trades, markets, 1)
    assert rows(out, "category") == [(None, 1, 1, 1, 3.0, 3.0), ("x", 4, 2, 2, 3.0, 1.0), ("y", 3, 2, 1, 2.0, 1.0)]
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    same_as_oracle(spark, "category_stats")


def test_joins_of_the_trade_fact_are_cut_and_narrow(spark, small_slices):
    from conftest import SF
    from tallyforge.adapters import Lake

    v = Lake(spark, SF)
    plan = silver.trade_fact(v.trades, v.market_tokens, v.traders)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression [wallet") == 1 and plan.count("RepartitionByExpression") == 3
    same_as_oracle(spark, "load_trade_fact")


def test_pages_are_numbered_once(spark, small_slices, monkeypatch):
    from tallyforge.plans import lake

    names, made = [], lake.written
    monkeypatch.setattr(lake, "written", lambda frame, name: names.append(name) or made(frame, name))
    same_as_oracle(spark, "growing_size_floor")
    assert names == ["pages"]


def test_a_batch_is_made_once_and_a_bucket_is_one_file(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            made.add(len(f))
            yield f

    df = spark.range(5_000).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    table = KeyedTable(spark, f"{tmp_path}/t", df.schema, ["k"], buckets=8)
    table.merge(df, 0, lambda old, new: old.unionByName(new.mapInPandas(count, new.schema)))
    assert made.value == 5_000 and table.read().count() == 5_000
    assert sorted(len(list(b.glob("*.parquet"))) for b in (tmp_path / "t/data/v0").glob("bucket=*")) == [1] * 8
