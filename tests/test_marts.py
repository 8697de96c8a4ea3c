from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from sectorlens import schemas, session
from sectorlens.operators import lookup, quality
from sectorlens.functions import times
from sectorlens.plans import marts
from tests.helpers import at, plan_of, rows

T0, T1, T2 = at("2025-01-02 10:00:00"), at("2025-01-02 10:15:00"), at("2025-01-02 10:30:00")


def sector_frame(spark, *bars):
    data = [(t, s, 0.0, h, 0.0, 0.0) for t, s, h in bars]
    return spark.createDataFrame(data, schemas.STOCK_SECTOR).repartition(3)


@pytest.fixture(scope="module")
def dims(spark):
    sectors = spark.createDataFrame([("S", "Sector S", "^S"), ("T", "Sector T", "^T")], schemas.SECTOR_INFO)
    industries = spark.createDataFrame(
        [("i1", "Ind 1", "^1", 0.25, "S"), ("i2", "Ind 2", "^2", 0.75, "S"), ("i3", "Ind 3", "^3", 1.0, "T")],
        schemas.INDUSTRY_INFO,
    )
    companies = spark.createDataFrame(
        [("A", "Alpha", "i1"), ("B", "Beta", "i2"), ("C", "Gamma", "i1"), ("D", "Delta", "i3"), ("E", "Eps", "zz")],
        schemas.COMPANY_INFO,
    )
    return companies, industries, sectors


@pytest.fixture(scope="module")
def top(spark):
    return marts.stock_top_sector(sector_frame(spark, (T0, "S", 10.0), (T1, "S", 12.0)))


def news_frame(spark, *items):
    data = [(c, f"title {c}", f"summary {c}", None, k, t) for c, k, t in items]
    return spark.createDataFrame(data, schemas.NEWS).repartition(3)


def winner(df):
    return df.first()["sector"]


def test_change_and_winner(spark):
    bars = sector_frame(
        spark, (T0, "S", 10.0), (T1, "S", 12.0), (T0, "T", 10.0), (T1, "T", 13.0), (T0, "U", 1.0)
    )
    assert rows(marts.sector_change(bars)) == [(T1, "S", 12.0, 10.0, 0.2), (T1, "T", 13.0, 10.0, 0.3)]
    top = marts.stock_top_sector(bars)
    assert top.columns == ["datetime", "sector", "high", "prev_high", "diff_percent"]
    assert rows(top) == [(T1, "T", 13.0, 10.0, 0.3)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_sector_without_newest_bar_cannot_win(spark):
    bars = sector_frame(spark, (T0, "S", 10.0), (T1, "S", 99.0), (T1, "T", 10.0), (T2, "T", 9.0))
    assert winner(marts.stock_top_sector(bars)) == "T"


def test_tie_goes_to_the_lower_key_and_fall_wins_only_by_size(spark):
    tie = sector_frame(spark, (T0, "B", 10.0), (T1, "B", 12.0), (T0, "A", 5.0), (T1, "A", 6.0))
    assert winner(marts.stock_top_sector(tie)) == "A"
    crash = sector_frame(spark, (T0, "B", 10.0), (T1, "B", 11.0), (T0, "A", 10.0), (T1, "A", 1.0))
    assert winner(marts.stock_top_sector(crash)) == "B"
    assert winner(marts.stock_top_sector(crash, direction="abs")) == "A"


def test_nulls_and_zero(spark):
    bars = sector_frame(
        spark, (T0, "Z", 0.0), (T1, "Z", 5.0), (T0, "N", 10.0), (T1, "N", None), (T0, "R", 2.0), (T1, "R", 1.0)
    )
    changes = {r["sector"]: r["diff_percent"] for r in marts.sector_change(bars).collect()}
    assert changes == {"Z": None, "N": None, "R": -0.5}
    assert winner(marts.stock_top_sector(bars)) == "R"
    assert winner(marts.stock_top_sector(bars, null_first=True)) == "N"


def test_previous_high_missing_falls_back_to_an_older_bar(spark):
    bars = sector_frame(spark, (T0, "S", 10.0), (T1, "S", 11.0), (T2, "S", 12.0))
    gap = bars.withColumn("high", F.when(F.col("datetime") != T1, F.col("high")))
    assert rows(marts.stock_top_sector(gap).select("datetime", "high")) == [(T1, None)]


def test_bar_loaded_twice_counts_once(spark):
    bars = sector_frame(spark, (T0, "S", 10.0), (T1, "S", 5.0), (T1, "S", 5.0), (None, "S", 7.0))
    assert rows(marts.sector_change(bars)) == [(T1, "S", 5.0, 10.0, -0.5)]
    assert marts.sector_change(bars, since=T1).count() == 0


def test_since_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "bars")
    bars = sector_frame(spark, (at("2025-01-01 10:00:00"), "S", 1.0), (T0, "S", 10.0), (T1, "S", 12.0))
    bars.withColumn("date", F.to_date("datetime")).write.partitionBy("date").parquet(path)
    recent = marts.sector_change(spark.read.parquet(path), since="2025-01-02 00:00:00")
    assert rows(recent.select("high", "prev_high")) == [(12.0, 10.0)]
    # the rows are merged by an earlier job, whose scan this is
    scan = marts._from(spark.read.parquet(path), times.run_time("2025-01-02 00:00:00"))
    assert "PartitionFilters: [isnotnull(date" in plan_of(scan)


def test_company_detail_keeps_unmatched(spark, dims):
    got = {r["company_symbol"]: (r["industry_name"], r["sector_name"]) for r in marts.company_detail(*dims).collect()}
    assert got["A"] == ("Ind 1", "Sector S") and got["E"] == (None, None) and len(got) == 5


def test_companies_and_industries_of_the_top_sector(spark, dims, top):
    companies, industries, _ = dims
    assert rows(marts.top_sector_companies(companies, industries, top)) == [
        ("A", "Alpha", "i1", "S"), ("B", "Beta", "i2", "S"), ("C", "Gamma", "i1", "S")
    ]
    got = marts.in_read_order(marts.top_sector(industries, top), "top_sector")
    assert [tuple(r) for r in got.collect()] == [("S", "i2", "Ind 2", 0.75), ("S", "i1", "Ind 1", 0.25)]


NEWS = [
    ("n1", "A", T2), ("n1", "B", T2), ("n1", "C", T2),  # one article, three companies
    ("n2", "A", T1), ("n3", "A", T0), ("n4", "B", T0), ("n5", "A", None),
    ("x1", "D", T2), ("x2", "nobody", T2),
]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_top_sector_news(spark, dims, top, limit):
    companies, industries, _ = dims
    news = news_frame(spark, *NEWS)
    args = (news, companies, industries, top)
    got = marts.top_sector_news(*args, limit=limit)
    assert got.columns == ["pubdate", "title", "summary", "company_name", "sector"]
    picked = sorted((r["title"], r["company_name"]) for r in got.collect())
    assert picked == [
        ("title n1", "Alpha"), ("title n1", "Beta"), ("title n1", "Gamma"), ("title n2", "Alpha"), ("title n3", "Alpha"),
    ]
    once = marts.top_sector_news(*args, distinct_articles=True, limit=limit)
    assert sorted(r["title"] for r in once.collect()) == [f"title n{i}" for i in range(1, 6)]
    nulls = marts.top_sector_news(*args, k=1, null_first=True, limit=limit)
    assert nulls.first()["title"] == "title n5"


@pytest.mark.parametrize("limit", [0, 10**9])
def test_top_sector_company_news(spark, dims, top, limit):
    companies, industries, _ = dims
    got = marts.top_sector_company_news(
        news_frame(spark, *NEWS), companies, industries, top, k=2, limit=limit
    )
    picked = sorted((r["company_name"], r["title"]) for r in got.collect())
    assert picked == [
        ("Alpha", "title n1"), ("Alpha", "title n2"), ("Beta", "title n1"), ("Beta", "title n4"), ("Gamma", "title n1"),
    ]


def test_hot_company_moves_only_k_rows_per_task(spark, dims, top):
    companies, industries, _ = dims
    news = spark.range(0, 30_000, 1, 6).select(
        F.col("id").cast("string").alias("content_id"),
        F.lit("t").alias("title"),
        F.lit("s").alias("summary"),
        F.lit(None).cast("string").alias("url"),
        F.expr("if(id < 0, 'B', 'A')").alias("company_key"),
        F.timestamp_seconds("id").alias("pubdate"),
    )
    for limit in (0, 10**9):
        got = marts.top_sector_company_news(news, companies, industries, top, limit=limit)
        plan = plan_of(got)
        partial = plan.index(", Partial")
        assert "Exchange hashpartitioning(company_key" in plan[:partial]
        assert [r["pubdate"].timestamp() for r in got.orderBy("pubdate").collect()] == list(range(29_995, 30_000))


@pytest.mark.parametrize("limit", [0, 10**9])
def test_stock_with_industry(spark, dims, limit):
    bars = spark.createDataFrame(
        [(T0, s, 1.0, 2.0, 0.5, 1.5, 10) for s in ("A", "E", "nobody")], schemas.STOCK_COMPANY
    )
    got = marts.stock_with_industry(bars, *dims, limit=limit)
    assert rows(got) == [
        (T0, 1.0, 2.0, 0.5, 1.5, 10, "Alpha", "Ind 1", "S"),
        (T0, 1.0, 2.0, 0.5, 1.5, 10, "Eps", None, None),
    ]


def test_refresh_stores_all_models(spark, dims):
    companies, industries, sectors = dims
    raw = {
        "company_info": companies,
        "industry_info": industries,
        "sector_info": sectors,
        "stock_sector": sector_frame(spark, (T0, "S", 10.0), (T1, "S", 12.0)),
        "stock_company": spark.createDataFrame([(T0, "A", 1.0, 2.0, 0.5, 1.5, 10)], schemas.STOCK_COMPANY),
        "news": news_frame(spark, *NEWS),
    }
    folder = session.scratch_dir(spark, "marts")
    for _ in range(2):  # rebuilt on each run
        stored = marts.refresh(raw, "analytics_test", folder)
    assert {name: df.count() for name, df in stored.items()} == {
        "top_sector": 2, "top_sector_news": 5, "top_sector_company_news": 7, "stock_with_industry": 1,
    }
    checks = quality.check_tables({k: v for k, v in stored.items() if k in quality.DECLARED})
    failed = checks.where("failures > 0").collect()
    # the article without a time is the only finding
    assert [(r["table"], r["column"], r["failures"]) for r in failed] == [("top_sector_company_news", "pubdate", 1)]


def test_days_not_named_keep_their_files(spark, dims):
    companies, industries, sectors = dims
    day = timedelta(days=1)
    bar = lambda t, volume: (t, "A", 1.0, 2.0, 0.5, 1.5, volume)
    raw = {
        "company_info": companies, "industry_info": industries, "sector_info": sectors,
        "stock_sector": sector_frame(spark, (T0, "S", 10.0), (T1, "S", 12.0)), "news": news_frame(spark, *NEWS),
    }
    folder = session.scratch_dir(spark, "days")

    def refreshed(volume, days):
        bars = [bar(T0, volume), bar(T0 + day, volume), bar(T0 + 2 * day, volume), bar(None, volume)]
        bars = {"stock_company": spark.createDataFrame(bars, schemas.STOCK_COMPANY)}
        stored = marts.refresh(raw | bars, "analytics_days", folder, days)["stock_with_industry"]
        return [r["volume"] for r in stored.orderBy(F.col("datetime").asc_nulls_last()).collect()], set(stored.inputFiles())

    assert refreshed(1, [str(T0.date())])[0] == [1, 1, 1, 1]  # no table yet: all days
    _, before = refreshed(1, None)
    volumes, after = refreshed(5, [str((T0 + day).date())])
    assert volumes == [1, 5, 1, 1]
    assert len(before & after) == 3 and len(after) == 4
    assert refreshed(7, [None])[0] == [1, 5, 1, 7]
    assert refreshed(8, [])[0] == [1, 5, 1, 7]
    assert refreshed(9, None)[0] == [9, 9, 9, 9]


def test_empty_tables_give_empty_models(spark):
    raw = {name: spark.createDataFrame([], schema) for name, schema in schemas.RAW_TABLES.items()}
    stored = marts.refresh(raw, "analytics_empty", session.scratch_dir(spark, "empty"))
    assert {name: df.count() for name, df in stored.items()} == dict.fromkeys(stored, 0)


@pytest.mark.parametrize("limit", [0, lookup.BROADCAST_BYTES])
def test_distinct_articles_do_not_depend_on_the_plan(spark, limit):
    companies = spark.createDataFrame([("A", "Co A", "i"), ("B", "Co B", "i")], "company_symbol string, company_name string, industry_key string")
    industries = spark.createDataFrame([("i", "I", "", 1.0, "s")], schemas.INDUSTRY_INFO)
    top = spark.createDataFrame([("s",)], "sector string")
    news = spark.createDataFrame(
        [("x", "A", "x", "", "", at("2025-01-01T00:00:00")), ("x", "B", "x", "", "", at("2025-01-03T00:00:00")), ("y", "A", "y", "", "", at("2025-01-02T00:00:00"))],
        "content_id string, company_key string, title string, summary string, url string, pubdate timestamp",
    )
    args = (companies, industries, top)
    got = marts.top_sector_news(news, *args, k=1, distinct_articles=True, limit=limit)
    assert rows(got.select("title", "company_name")) == [("y", "Co A")]
    nameless = news.withColumn("content_id", F.lit(None).cast("string"))
    assert marts.top_sector_news(nameless, *args, k=9, distinct_articles=True, limit=limit).count() == 3


def test_settled_top_sector_is_the_top_sector(spark):
    day = timedelta(days=1)
    cases = [
        sector_frame(spark),
        sector_frame(spark, (T0, "S", 1.0)),
        sector_frame(spark, (T0, "S", 1.0), (T1, "S", 2.0), (T1, "T", 9.0)),  # T has no earlier bar
        sector_frame(spark, (T0 - 30 * day, "S", 1.0), (T0 - day / 2, "T", 1.0), (T0, "S", 3.0), (T0, "T", 2.0)),
        sector_frame(spark, (T0 - 300 * day, "S", 1.0), (T0, "S", 3.0), (T0, None, 2.0)),
        # the high before the newest bar is unknown, so an older time leads
        sector_frame(spark, (T0, "S", 1.0), (T1, "S", None), (T2, "S", 3.0)),
        sector_frame(spark, (T0, "S", 1.0), (T1, "S", 2.0), (T2, "S", None), (T2, "T", None)),
    ]
    for bars in cases:
        assert rows(marts.settled_top_sector(bars)) == rows(marts.stock_top_sector(bars))


def test_previous_bar_reads_its_input_once(spark, tmp_path):
    bars = sector_frame(spark, (T0, "S", 10.0), (T1, "S", 5.0))
    bars.write.parquet(f"{tmp_path}/bars")
    change = marts.sector_change(spark.read.parquet(f"{tmp_path}/bars"))
    change.collect()
    plan = plan_of(change)
    # one job has read and merged the rows; limits and ranges read what it kept
    assert "FileScan" not in plan and plan.count("Scan ExistingRDD") >= 1
    assert "SortAggregate" not in plan
