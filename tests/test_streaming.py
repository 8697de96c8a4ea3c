import random
from datetime import timedelta

from pyspark.sql import functions as F

from sectorlens import schemas
from sectorlens.operators import bars as bar_ops
from sectorlens.plans import marts
from sectorlens.streaming import jobs
from tests.helpers import at, rows
from tests.test_operators import ticks_of

T0 = at("2025-01-02 10:00:00")


def test_clean_and_append_reads_each_file_once(spark, tmp_path):
    vendor = {ours: theirs for theirs, ours in schemas.LANDING_FIELDS.items()}

    def land(n):
        spark.createDataFrame([(T0 + timedelta(minutes=n), "S", 1.0, 1.0, 1.0, 1.0), (None, "S", 1.0, 1.0, 1.0, 1.0)], schemas.STOCK_SECTOR).withColumnsRenamed(
            vendor
        ).withColumn("Volume", F.lit(0.0)).write.parquet(f"{tmp_path}/landed/{n}")

    def run():
        schema = spark.read.parquet(f"{tmp_path}/landed/0").schema
        landed = jobs.file_stream(spark, f"{tmp_path}/landed", schema)
        jobs.clean_and_append(landed, "sector", f"{tmp_path}/out", f"{tmp_path}/cp")
        return spark.read.parquet(f"{tmp_path}/out").count()

    land(0)
    assert run() == 2 and run() == 2
    land(15)
    assert run() == 4
    assert spark.read.parquet(f"{tmp_path}/out").where("datetime is null and date is null").count() == 2


def news(spark, *items):
    return spark.createDataFrame(
        [(c, k, t, f"{c} at {t}") for c, k, t in items],
        "content_id string, company_key string, pubdate timestamp, title string",
    )


def hot_batches(spark, tmp_path):
    """An article repeated in most rows, over two batches; one article without a time."""
    first = news(spark, *[("hot", "A", T0)] * 500, ("x", "A", T0), ("n", "A", None))
    second = news(spark, *[("hot", "A", T0)] * 500, ("hot", "B", T0), ("y", "A", T0 + timedelta(hours=1)))
    path = f"{tmp_path}/news"
    schema = first.schema

    def drain(job):
        job(jobs.file_stream(spark, path, schema), f"{tmp_path}/out", f"{tmp_path}/cp")

    return path, first, second, drain


def test_new_news_once(spark, tmp_path):
    path, first, second, drain = hot_batches(spark, tmp_path)
    for batch in (first, second):
        batch.repartition(4).write.mode("append").parquet(path)
        drain(jobs.append_new_news)
    got = spark.read.parquet(f"{tmp_path}/out").select("content_id", "company_key")
    assert rows(got) == [("hot", "A"), ("hot", "B"), ("x", "A"), ("y", "A")]


def test_ingest_stream_keeps_what_has_no_time(spark, tmp_path):
    path, first, second, drain = hot_batches(spark, tmp_path)
    for batch in (first, second, second):
        batch.repartition(4).write.mode("append").parquet(path)
        drain(jobs.ingest_new_news)
    got = spark.read.parquet(f"{tmp_path}/out").select("content_id", "company_key")
    assert rows(got) == [("hot", "A"), ("hot", "B"), ("n", "A"), ("x", "A"), ("y", "A")]


def test_tick_bars_equal_batch_bars(spark, tmp_path):
    _, ticks = ticks_of(spark)
    timed = ticks.where("ts is not null").orderBy("ts")
    timed.repartitionByRange(4, "ts").write.parquet(f"{tmp_path}/ticks")
    for _ in range(2):
        stream = jobs.file_stream(spark, f"{tmp_path}/ticks", ticks.schema, files_per_batch=2)
        jobs.tick_bars(stream, "company_symbol", f"{tmp_path}/bars", f"{tmp_path}/cp")
    got = jobs.read_tick_bars(spark, f"{tmp_path}/bars", "company_symbol")
    assert rows(got) == rows(bar_ops.ohlcv(ticks, ["company_symbol"]))
    assert spark.read.parquet(f"{tmp_path}/bars").select("batch").distinct().count() >= 2


def test_top_sector_follows_late_bars(spark, tmp_path):
    def land(*bars):
        data = [(T0 + timedelta(minutes=m), s, 0.0, h, 0.0, 0.0) for m, s, h in bars]
        spark.createDataFrame(data, schemas.STOCK_SECTOR).write.mode("append").parquet(f"{tmp_path}/landed")
        stream = jobs.file_stream(spark, f"{tmp_path}/landed", schemas.STOCK_SECTOR)
        jobs.follow_top_sector(stream, f"{tmp_path}/lead", f"{tmp_path}/cp")
        return tuple(jobs.read_top_sector(spark, f"{tmp_path}/lead").first())[1:4]

    assert land((0, "S", 10.0), (30, "S", 12.0), (0, "T", 10.0), (30, "T", 11.0)) == ("S", 12.0, 10.0)
    assert land((15, "T", 5.0)) == ("T", 11.0, 5.0)  # late: T's rise is now larger
    assert rows(jobs.read_top_sector(spark, f"{tmp_path}/lead")) == rows(
        marts.stock_top_sector(spark.read.schema(schemas.STOCK_SECTOR).parquet(f"{tmp_path}/landed"))
    )
    # two days later: the bar before S's newest is older than the last day, and still counts
    day2 = 2 * 24 * 60
    assert land((day2, "S", 99.0), (day2, "T", 11.0), (day2 - 15, "T", 10.0)) == ("S", 99.0, 12.0)
    assert land((day2 + 15, "T", 1.0), (day2 + 15, "S", 9.9)) == ("S", 9.9, 99.0)


def test_late_ticks_are_not_lost(spark, tmp_path):
    def land(*ticks):
        data = [("A", T0 + timedelta(minutes=m), p, n) for n, (m, p) in enumerate(ticks)]
        frame = spark.createDataFrame(data, "company_symbol string, ts timestamp, price double, seq long")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/ticks")
        stream = jobs.file_stream(spark, f"{tmp_path}/ticks", frame.schema)
        jobs.tick_bars(stream, "company_symbol", f"{tmp_path}/bars", f"{tmp_path}/cp")
        return rows(jobs.read_tick_bars(spark, f"{tmp_path}/bars", "company_symbol").select("datetime", "open", "close", "volume"))

    noon = T0 + timedelta(minutes=120)
    assert land((121, 5.0)) == [(noon, 5.0, 5.0, 1)]
    # three hours late, and a tick before the first one of a window stored already
    assert land((-60, 7.0), (120, 4.0)) == [(noon, 4.0, 5.0, 2), (T0 - timedelta(hours=1), 7.0, 7.0, 1)]


def land_sector_bars(spark, path, bars):
    data = [(T0 + timedelta(minutes=m), s, 0.0, h, 0.0, 0.0) for m, s, h in bars]
    spark.createDataFrame(data, schemas.STOCK_SECTOR).coalesce(1).write.mode("append").parquet(f"{path}/landed")


def follow_changes(spark, path, **options):
    stream = jobs.file_stream(spark, f"{path}/landed", schemas.STOCK_SECTOR, files_per_batch=1)
    jobs.follow_sector_changes(stream, f"{path}/changes", f"{path}/cp", **options)
    return spark.read.parquet(f"{path}/changes")


def test_late_bar_corrects_itself_and_its_successor(spark, tmp_path):
    land_sector_bars(spark, tmp_path, [(0, "S", 10.0), (30, "S", 12.0), (60, "S", 13.0), (24 * 60 * 3, "S", 20.0)])
    first = follow_changes(spark, tmp_path)
    assert first.count() == 4
    land_sector_bars(spark, tmp_path, [(15, "S", 11.0), (24 * 60, "S", 15.0), (24 * 60, "S", 14.0), (60, "S", 1.0)])
    later = follow_changes(spark, tmp_path).where("version > 4").orderBy("datetime")
    minutes = [((r["datetime"] - T0).total_seconds() / 60, r["high"], r["prev_high"]) for r in later.collect()]
    # the copy with a lower high changes nothing; days without bars are passed over
    assert minutes == [(15, 11.0, 10.0), (30, 12.0, 11.0), (24 * 60, 15.0, 13.0), (24 * 60 * 3, 20.0, 15.0)]


def test_last_corrections_equal_the_whole_change(spark, tmp_path):
    pick = random.Random(5)
    nan = float("nan")
    bars = [(pick.randint(0, 40) * 15 + pick.randint(0, 5) * 1440, s, pick.choice([None, nan, 0.0, 1.0, 2.5, 7.0])) for s in "STU" for _ in range(120)]
    pick.shuffle(bars)
    for i in range(4):
        land_sector_bars(spark, tmp_path, bars[i * 90 : i * 90 + 90])
        if i % 2:
            follow_changes(spark, tmp_path)
    every = spark.read.schema(schemas.STOCK_SECTOR).parquet(f"{tmp_path}/landed")
    got = rows(jobs.read_sector_changes(spark, f"{tmp_path}/changes"))
    assert got and str(got) == str(rows(marts.sector_change(every)))
    before = spark.read.parquet(f"{tmp_path}/changes").count()
    assert follow_changes(spark, tmp_path).count() == before


def test_kept_span_bounds_the_state(spark, tmp_path):
    day = 24 * 60
    for n in range(8):
        land_sector_bars(spark, tmp_path, [(n * day, "S", 10.0 + n), (n * day + 30, "S", 20.0 + n)])
    follow_changes(spark, tmp_path, keep="2 days")
    land_sector_bars(spark, tmp_path, [(6 * day + 15, "S", 5.0), (15, "S", 5.0), (9 * day, "S", 1.0)])
    follow_changes(spark, tmp_path, keep="2 days")
    changed = {(r["datetime"] - T0).total_seconds() / 60: r["prev_high"] for r in jobs.read_sector_changes(spark, f"{tmp_path}/changes").collect()}
    assert changed[6 * day + 30] == 5.0 and changed[30] == 10.0 and changed[9 * day] == 27.0 and 15 not in changed
    state = spark.read.format("statestore").option("stateVarName", "bars").load(f"{tmp_path}/cp")
    days = state.select("user_map_key.day").distinct().count()
    assert days <= 5


def test_top_sector_when_the_newest_change_is_taken_back(spark, tmp_path):
    def land(*bars):
        land_sector_bars(spark, tmp_path, bars)
        stream = jobs.file_stream(spark, f"{tmp_path}/landed", schemas.STOCK_SECTOR)
        jobs.follow_top_sector(stream, f"{tmp_path}/lead", f"{tmp_path}/cp")
        return rows(jobs.read_top_sector(spark, f"{tmp_path}/lead"))

    land((0, "S", 10.0), (15, "S", 11.0), (0, "T", 10.0), (45, "T", 12.0))
    # a bar without a high before the newest one: its change is unknown now
    got = land((30, "T", None))
    assert got == rows(marts.stock_top_sector(spark.read.schema(schemas.STOCK_SECTOR).parquet(f"{tmp_path}/landed")))
    assert got[0][:2] == (T0 + timedelta(minutes=30), "T")
