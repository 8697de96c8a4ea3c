import random
from datetime import timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sectorlens.operators import bars as bar_ops
from sectorlens.operators import dedupe, lookup, quality, topk
from sectorlens.operators import previous
from sectorlens.operators.previous import with_previous
from tests.helpers import at, plan_of, rows

NOON = at("2025-01-02 12:00:00")
TICKS = "company_symbol string, ts timestamp, price double, seq long"


def ticks_of(spark, n=600, seed=3):
    rng = random.Random(seed)
    data = []
    for seq in range(n):
        # a third of all ticks belong to one company, and many share one instant
        symbol = "HOT" if rng.random() < 0.34 else f"c{rng.randrange(12)}"
        ts = NOON + timedelta(seconds=rng.randrange(0, 6000, 60))
        data.append((symbol, ts, float(rng.randrange(100)), seq))
    rng.shuffle(data)
    data += [("HOT", None, 1.0, n), ("HOT", NOON, None, n + 1)]
    return data, spark.createDataFrame(data, TICKS).repartition(5)


def expected_bars(data, key):
    slots = {}
    for symbol, ts, price, seq in data:
        if ts is None or price is None or key(symbol) is None:
            continue
        start = ts.replace(minute=ts.minute // 15 * 15, second=0)
        slots.setdefault((start, key(symbol)), []).append((ts, seq, price))
    out = []
    for (start, k), found in slots.items():
        found.sort()
        prices = [p for _, _, p in found]
        out.append((start, k, prices[0], max(prices), min(prices), prices[-1], len(found)))
    return sorted(out, key=str)


def test_ohlcv_equals_brute_force(spark):
    data, ticks = ticks_of(spark)
    assert rows(bar_ops.ohlcv(ticks, ["company_symbol"])) == expected_bars(data, lambda s: s)


def test_volume_is_the_sum_of_sizes(spark):
    _, ticks = ticks_of(spark)
    sized = ticks.withColumn("size", F.lit(3).cast("long"))
    plain = bar_ops.ohlcv(ticks, ["company_symbol"]).withColumn("volume", F.col("volume") * 3)
    assert rows(bar_ops.ohlcv(sized, ["company_symbol"])) == rows(plain)


def test_tick_order_is_exact_at_the_ends(spark):
    times_ = [at("1969-01-01 00:00:00"), at("2025-01-01 00:00:00"), at("9999-12-31 23:59:59")]
    data = [(t, s) for t in times_ for s in (0, 1, 2**63 - 1)]
    df = spark.createDataFrame(data[::-1], "ts timestamp, seq long")
    ordered = df.orderBy(bar_ops.tick_order(F.col("ts"), F.col("seq"))).collect()
    assert [tuple(r) for r in ordered] == data


@pytest.mark.parametrize("limit", [0, lookup.BROADCAST_BYTES])
def test_sector_bars_alike_with_and_without_broadcast(spark, limit):
    data, ticks = ticks_of(spark)
    sector = {"HOT": "0", **{f"c{i}": str(i % 3) for i in range(10)}}  # c10, c11 are unknown
    companies = spark.createDataFrame(
        [(s, s, k) for s, k in sector.items()] + [("nobody", "nobody", "9")],
        "company_symbol string, company_name string, industry_key string",
    )
    industries = spark.createDataFrame(
        [("0", "energy"), ("1", "tech"), ("2", None)], "industry_key string, sector_key string"
    )
    names = {"0": "energy", "1": "tech"}
    got = bar_ops.sector_bars(ticks, companies, industries, limit=limit)
    want = expected_bars(data, lambda s: names.get(sector.get(s)))
    assert rows(got.select("datetime", "sector", "open", "high", "low", "close", "volume")) == want


def test_bars_are_hash_aggregated_before_the_shuffle(spark):
    _, ticks = ticks_of(spark)
    plan = plan_of(bar_ops.ohlcv(ticks, ["company_symbol"]))
    assert "SortAggregate" not in plan and "partial_min_by" in plan


def test_slot_bars_read_only_their_slot(spark, tmp_path):
    data, ticks = ticks_of(spark)
    ticks.write.parquet(f"{tmp_path}/ticks")
    stored = spark.read.parquet(f"{tmp_path}/ticks")
    now = NOON + timedelta(minutes=34, seconds=7)  # expects the bar of 12:15
    got = bar_ops.slot_bars(stored, ["company_symbol"], now)
    slot = NOON + timedelta(minutes=15)
    assert rows(got) == [b for b in expected_bars(data, lambda s: s) if b[0] == slot]
    assert "LessThan(ts,2025-01-02 12:30:00.0)" in plan_of(got)
    # no bar starts at 12:16
    assert bar_ops.slot_bars(stored, ["company_symbol"], now + timedelta(minutes=1)).count() == 0


def test_last_bar_and_freshness(spark):
    _, ticks = ticks_of(spark)
    bars = bar_ops.ohlcv(ticks, ["company_symbol"])
    newest = {}
    for r in bars.collect():
        if r["datetime"] >= newest.get(r["company_symbol"], r)["datetime"]:
            newest[r["company_symbol"]] = r
    last = bar_ops.last_bar(bars, "company_symbol")
    assert {r["company_symbol"]: r["datetime"] for r in last.collect()} == {
        k: r["datetime"] for k, r in newest.items()
    }
    three = spark.createDataFrame(
        [("fresh", NOON), ("stale", NOON - timedelta(minutes=15)), ("fresh", None)],
        "company_symbol string, datetime timestamp",
    )
    keys = spark.createDataFrame([("fresh",), ("stale",), ("gone",), (None,)], "company_symbol string")
    stale = bar_ops.stale_keys(keys, three, "company_symbol", NOON + timedelta(minutes=19, seconds=5))
    assert {r["company_symbol"]: r["status"] for r in stale.collect()} == {
        "stale": "stale",
        "gone": "missing",
    }
    with pytest.raises(bar_ops.DataNotFound, match="gone: missing"):
        bar_ops.require_fresh(stale.orderBy("company_symbol"), "company_symbol")
    bar_ops.require_fresh(stale.where("false"), "company_symbol")


@pytest.mark.parametrize("range_rows", [1, 7, 50, 100_000])
def test_with_previous_equals_one_window(spark, range_rows):
    rng = random.Random(5)
    data = [
        (
            rng.choice(["a", "a", "a", "b", None]),
            NOON + timedelta(minutes=rng.randrange(4000)) if rng.random() < 0.95 else None,
            None if rng.random() < 0.1 else float(rng.randrange(50)),
        )
        for _ in range(900)
    ]
    data += [("a", NOON, 7.0)] * 300  # copies of one row
    df = spark.createDataFrame(data, "k string, t timestamp, v double").repartition(6)
    got = with_previous(df, ["k"], "t", "v", "prev", range_rows)
    one = (
        df.where("t is not null")
        .groupBy("k", "t")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("v").alias("v"))
        .withColumn("prev", F.lag("v", 1).over(Window.partitionBy("k").orderBy("t")))
    )
    assert rows(got.select("k", "t", "copies", "prev", "v")) == rows(
        one.select("k", "t", "copies", "prev", "v")
    )


def test_previous_time_and_several_keys(spark):
    rng = random.Random(9)
    data = [(rng.choice("ab"), rng.choice([1, 2, None]), NOON + timedelta(microseconds=rng.randrange(10**9))) for _ in range(400)]
    df = spark.createDataFrame(data, "k string, n int, t timestamp").repartition(5)
    got = with_previous(df, ["k", "n"], "t", "t", "prev", 9)
    one = df.groupBy("k", "n", "t").agg(F.count(F.lit(1)).alias("copies"))
    one = one.withColumn("prev", F.lag("t", 1).over(Window.partitionBy("k", "n").orderBy("t")))
    assert rows(got.select("k", "n", "t", "copies", "prev")) == rows(one.select("k", "n", "t", "copies", "prev"))


def test_half_of_all_rows_within_a_minute_spread_over_ranges(spark):
    """One key has half of all rows within one minute; its ranges are as small as the others."""
    n = 40_000
    dense = spark.range(n // 2).select(F.lit("hot").alias("k"), F.timestamp_micros(F.col("id") * 2500).alias("t"), F.col("id").cast("double").alias("v"))
    wide = spark.range(n // 2).select(
        F.concat(F.lit("k"), F.col("id") % 10).alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("t"), F.col("id").cast("double").alias("v")
    )
    df = dense.unionByName(wide)
    got = with_previous(df, ["k"], "t", "v", "prev", 1000)
    windows = [line for line in plan_of(got).splitlines() if "Window [" in line]
    # rows by key and range, and one carried value a range by key
    assert len(windows) == 2 and "__range" in windows[0].split("ASC")[0] and "__time" not in windows[1]
    wrong = got.where("k = 'hot' AND NOT coalesce(prev = v - 1, v = 0)").count()
    wrong += got.where("k <> 'hot' AND NOT coalesce(prev = v - 10, v < 10)").count()
    assert wrong == 0 and got.count() == n
    merged = df.select("k", F.unix_micros("t").alias("__time"))
    cut = previous.in_ranges(merged, previous.time_limits(merged, 1000))
    sizes = cut.groupBy("k", "__range").count().toPandas()["count"]
    assert cut.select("__range").distinct().count() >= 35 and sizes.max() < 2000


def test_newest_per_cuts_before_the_shuffle(spark):
    news = spark.createDataFrame(
        [("A", str(i), NOON + timedelta(minutes=i % 7)) for i in range(50)] + [("A", "n", None)],
        "company_key string, content_id string, pubdate timestamp",
    )
    top = topk.newest_per(news, ["company_key"], 3, ties=("content_id",))
    assert rows(top.select("rn", "content_id")) == [(1, "13"), (2, "20"), (3, "27")]
    nulls = topk.newest_per(news, ["company_key"], 1, ties=("content_id",), null_first=True)
    assert nulls.first()["content_id"] == "n"
    plan = plan_of(top)
    assert plan.count("WindowGroupLimit") >= 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def pair_frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "content_id string, company_key string")


def test_drop_seen_matches_null_keys(spark):
    keys = ["content_id", "company_key"]
    news = pair_frame(spark, (None, "A"), ("x", "A"), ("y", "B"), ("z", "A"), ("z", "A"))
    seen = pair_frame(spark, (None, "A"), ("x", "A"), ("x", "A"))
    assert rows(dedupe.drop_seen(news, seen, keys)) == [("y", "B"), ("z", "A"), ("z", "A")]
    assert dedupe.drop_seen(news, None, keys) is news
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    shuffled = dedupe.drop_seen(news, seen, keys)
    assert shuffled.count() == 3 and "SortMergeJoin" in plan_of(shuffled)
    assert plan_of(shuffled).split("Initial Plan")[-1].count("Exchange hashpartitioning") == 3
    spark.conf.set(threshold, before)
    empty = spark.createDataFrame([], news.schema)
    assert dedupe.drop_seen(news, empty, keys).count() == 5


def test_new_unique_keeps_the_newest_copy(spark):
    keys = ["content_id", "company_key"]
    news = spark.createDataFrame(
        [("z", "A", 1, "old"), ("z", "A", 2, "new"), (None, "A", 1, "n"), ("x", "A", 9, "seen")],
        "content_id string, company_key string, pubdate int, title string",
    )
    seen = pair_frame(spark, ("x", "A"), ("q", "Q"))
    assert rows(dedupe.new_unique(news, seen, keys, "pubdate")) == [
        ("z", "A", 2, "new"),
        (None, "A", 1, "n"),
    ]
    assert dedupe.new_unique(news, None, keys, "pubdate").count() == 3
    # two articles without an id are two articles, fetched twice they are still two
    other = spark.createDataFrame([(None, "A", 1, "another"), (None, "A", 1, "n")], news.schema)
    assert dedupe.new_unique(news.unionByName(other), None, keys, "pubdate").count() == 4
    assert dedupe.new_unique(other, pair_frame(spark, (None, "A")), keys, "pubdate").count() == 0


def test_whole_rows_of_the_heads_are_the_unique_rows(spark):
    keys = ["content_id", "company_key"]
    pick = random.Random(5)
    some = [tuple(pick.choice(values) for values in ([None, "x", "y", "z"], [None, "A", "B"], [None, 1, 2], [None, "s", "t"], [None, "u"])) for _ in range(300)]
    news = spark.createDataFrame(some, "content_id string, company_key string, pubdate int, title string, url string").repartition(5)
    seen = pair_frame(spark, ("x", "A"), (None, "B"), ("q", "Q"))
    want = rows(dedupe.new_unique(news, seen, keys, "pubdate"))
    new = dedupe.drop_seen(dedupe.heads(news, keys, "pubdate"), seen, keys)
    assert new.columns == [*keys, "__apart", "pubdate"]
    assert rows(dedupe.rows_of(news, new, keys, "pubdate")) == want and len(want) > 20
    assert dedupe.rows_of(news, new.where("false"), keys, "pubdate").isEmpty()


def test_keep_first(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "first"), (None, 4, "n2"), (None, 3, "n1")],
        "k string, pos int, v string",
    )
    assert rows(dedupe.keep_first(df, ["k"], ["pos"])) == [("a", 1, "first"), (None, 3, "n1")]


def test_hot_key_of_an_anti_join_is_split(spark):
    """Adaptive execution may split the large side of both kinds of join used here."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        news = spark.range(0, 200_000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("string").alias("content_id"),
            F.lit("A").alias("company_key"),
            F.sha2(F.col("id").cast("string"), 256).alias("title"),
        )
        seen = spark.range(5, 2000).select(
            F.col("id").cast("string").alias("content_id"), F.lit("A").alias("company_key")
        )
        new = dedupe.drop_seen(news, seen, ["content_id", "company_key"])
        assert new.count() == news.join(seen, ["content_id", "company_key"], "left_anti").count()
        new.toArrow()
        assert "skewed" in plan_of(new)
        named = lookup.lookup_join(news, seen.withColumnRenamed("company_key", "name"), "content_id", limit=0)
        named.toArrow()
        assert "skewed" in plan_of(named)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_lookup_is_broadcast_only_when_measured_small(spark):
    fact = spark.range(1000).select((F.col("id") % 50).cast("string").alias("k"))
    names = spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit("x" * 40).alias("name"))
    assert lookup.measured_bytes(names) >= 50 * 40
    assert "BroadcastHashJoin" in plan_of(lookup.lookup_join(fact, names, "k"))
    hinted = lookup.lookup_join(fact, names, "k", limit=100)
    assert "rHint=(strategy=broadcast)" not in hinted._jdf.queryExecution().optimizedPlan().toString()
    assert hinted.count() == 1000
    assert not lookup.fits_broadcast(names, limit=0)


def test_not_null_and_unique(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, None)], "k string, v int")
    assert rows(quality.null_counts(df, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(quality.repeated_values(df, "k")) == [("a", 2)]
    assert rows(quality.check_table("t", df, ["k"], ["k", "v"])) == [
        ("t", "k", "not_null", 2),
        ("t", "k", "unique", 1),
        ("t", "v", "unique", 0),
    ]


def test_declared_checks_are_all_there():
    assert sum(len(a) + len(b) for a, b in quality.DECLARED.values()) == 32


def test_news_key_repeats(spark):
    df = pair_frame(spark, ("x", "A"), ("x", "A"), ("x", "B"), (None, "A"), (None, "A"))
    assert rows(quality.news_key_repeats(df)) == [("A", "x", 2)]


def test_short_gaps(spark):
    t = [at(f"2025-01-02 10:{m}") for m in ("00:59", "15:01", "25:00", "25:00", "25:00")]
    data = [("s", x) for x in t] + [("s", None), ("other", t[0]), ("other", at("2025-01-01 00:00:00"))]
    bars = spark.createDataFrame(data, "sector string, datetime timestamp")
    assert rows(quality.short_gaps(bars)) == [
        ("s", t[1], t[2], 10, 1),
        ("s", t[2], t[2], 0, 2),
    ]
