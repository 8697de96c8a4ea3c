"""Small states that stand for whole tables: day rows of the leading sector, partial check results."""

import random
from datetime import timedelta

import pytest

from sectorlens import schemas
from sectorlens.operators import quality
from sectorlens.operators.checkstate import CheckState
from sectorlens.plans import leader, marts
from tests.helpers import at, plan_of, rows

T0 = at("2025-01-02 10:00:00")


def some_bars(seed, n, days, sectors="STU"):
    pick = random.Random(seed)
    high = lambda: pick.choice([None, None, 0.0, 1.0, 2.0, 4.0, 5.0])
    return [(T0 + timedelta(minutes=15 * pick.randrange(days * 40)), pick.choice(sectors), 0.0, high(), 0.0, 0.0) for _ in range(n)]


@pytest.mark.parametrize("seed", range(6))
def test_day_rows_give_the_leading_sector(spark, tmp_path, seed):
    bars = some_bars(seed, 6 + 15 * seed, 1 + seed) + [(None, "S", 0.0, 9.0, 0.0, 0.0)]
    frame = spark.createDataFrame(bars, schemas.STOCK_SECTOR).repartition(3)
    for direction in ("signed", "abs"):
        want = rows(marts.stock_top_sector(frame, direction))
        assert rows(leader.top_sector_of(leader.day_leads(frame), direction)) == want


def test_only_touched_days_are_rebuilt(spark, tmp_path):
    path = f"{tmp_path}/leads"
    bars = some_bars(9, 200, 6)
    frame = lambda some: spark.createDataFrame(some, schemas.STOCK_SECTOR)
    late = bars[::4]
    assert leader.read_day_leads(spark, path).count() == 0
    leader.refresh_day_leads(frame([b for b in bars if b not in late]), path)
    before = {f: open(f[5:], "rb").read() for f in spark.read.parquet(path).inputFiles()}
    touched = sorted({str(b[0].date()) for b in late})[:2]
    assert leader.refresh_day_leads(frame(bars), path, touched) > 0
    after = set(spark.read.parquet(path).inputFiles())
    kept = {f for f in before if not any(f"date={d}" in f for d in touched)}
    assert kept and kept <= after and not (set(before) - kept) & after
    leader.refresh_day_leads(frame(bars), path, sorted({str(b[0].date()) for b in late}))
    assert rows(leader.top_sector_of(leader.read_day_leads(spark, path))) == rows(marts.stock_top_sector(frame(bars)))


def test_leader_needs_no_window(spark):
    plan = plan_of(leader.top_sector_of(leader.day_leads(spark.createDataFrame(some_bars(1, 30, 3), schemas.STOCK_SECTOR))))
    assert "Window" not in plan


def load(spark, *items):
    return spark.createDataFrame([(k, b, n) for n, (k, b) in enumerate(items)], "key string, b string, n int")


def test_a_repeat_across_two_loads_is_found(spark, tmp_path):
    state = CheckState(spark, str(tmp_path), ["key", "b"], ["key", ("key", "b")])
    assert rows(state.result().select("failures")) == [(0,)] * 4

    def failures():
        return sorted((r["column"], r["test"], r["failures"]) for r in state.result().collect())

    one = load(spark, ("a", "1"), ("b", None), (None, "x")).selectExpr("*", "'p1' AS piece")
    two = load(spark, ("c", "1"), ("a", "2"), ("a", "2")).selectExpr("*", "'p2' AS piece")
    state.update(one, "piece")
    assert failures() == [("b", "not_null", 1), ("key", "not_null", 1), ("key", "unique", 0), ("key, b", "unique", 0)]
    state.update(two, "piece")
    assert failures() == [("b", "not_null", 1), ("key", "not_null", 1), ("key", "unique", 1), ("key, b", "unique", 1)]
    for limit in (0, 10**9):
        assert rows(state.repeats_in(["key"], ["p1"], limit)) == [("1:a", 3)]
        assert rows(state.repeats_in(["key", "b"], ["p1"], limit)) == []
    # the piece again, without its repeats
    state.update(load(spark, ("c", "1"), ("d", "2")).selectExpr("*", "'p2' AS piece"), "piece")
    assert failures() == [("b", "not_null", 1), ("key", "not_null", 1), ("key", "unique", 0), ("key, b", "unique", 0)]
    # and with nothing but nulls
    state.update(load(spark, (None, "1")).selectExpr("*", "'p1' AS piece"), "piece")
    assert failures() == [("b", "not_null", 0), ("key", "not_null", 1), ("key", "unique", 0), ("key, b", "unique", 0)]


def test_merged_checks_equal_the_full_pass(spark, tmp_path):
    pick = random.Random(4)
    word = lambda: pick.choice([None, "", "a", "ab", "1:", "b", "c", "d", "e"])
    items = [(word(), word()) for _ in range(60)]
    whole = load(spark, *items).selectExpr("*", "cast(n % 5 AS string) AS piece")
    state = CheckState(spark, str(tmp_path), ["key"], ["key", "b"])
    for n in (0, 3, 1, 3, 2, 4):
        state.update(whole.where(f"piece = '{n}'"), "piece")
    want = quality.check_table("t", whole, ["key"], ["key", "b"]).select("column", "test", "failures")
    assert rows(state.result()) == rows(want)
    both = CheckState(spark, f"{tmp_path}/both", [], [("key", "b")])
    both.update(whole, "piece")
    repeated = whole.where("key IS NOT NULL AND b IS NOT NULL").groupBy("key", "b").count().where("count > 1").count()
    assert both.result().first()["failures"] == repeated > 0


def test_the_result_reads_partials_only(spark, tmp_path):
    source = f"{tmp_path}/source"
    load(spark, ("a", "1"), ("a", "2")).selectExpr("*", "'p' AS piece").write.parquet(source)
    state = CheckState(spark, f"{tmp_path}/state", ["key"], ["key"])
    state.update(spark.read.parquet(source), "piece")
    read = state.result().inputFiles()
    assert read and all("/state/" in file for file in read)
