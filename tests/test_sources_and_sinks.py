import json
from datetime import date, timedelta

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sectorlens import schemas, session
from sectorlens.operators import bars as bar_ops
from sectorlens.operators import sinks
from sectorlens.plans import ingest
from sectorlens.sources import landing, masterdata, news, panels
from tests.helpers import at, plan_of, rows

T0 = at("2025-01-02 14:30:00")


def item(i, title="t", published="2025-01-02T10:00:00Z", **more):
    content = {"id": i, "title": title, "summary": "s", "pubDate": published, "canonicalUrl": {"url": f"u{i}"}}
    return {"content": content, **more}


def payload_file(path, *objects):
    path.mkdir(parents=True, exist_ok=True)
    (path / "batch.json").write_text("\n".join(json.dumps(o) for o in objects))
    return str(path)


def test_news_payload(spark, tmp_path):
    path = payload_file(
        tmp_path / "in",
        {"A": [item("1"), item("2", published="oops", company_key="other")], "B": [], "C": None},
        {"D": [item("1", published="2025-01-02T23:30:00-05:00")]},
    )
    got = ingest.news_rows(news.read_payloads(spark, path))
    assert got.schema.simpleString() == schemas.NEWS_LANDING.simpleString()
    assert rows(got) == [
        ("1", "t", "s", "u1", "A", "2025-01-02T10:00:00Z", date(2025, 1, 2)),
        ("1", "t", "s", "u1", "D", "2025-01-02T23:30:00-05:00", date(2025, 1, 3)),
        ("2", "t", "s", "u2", "A", "oops", None),
    ]
    whole = payload_file(tmp_path / "whole", {"A": [item("1"), item("2")]})
    assert news.news_items(news.read_payloads(spark, whole, whole_file=True)).count() == 2


def test_ingest_news_twice(spark, tmp_path):
    store = str(tmp_path / "store")
    first = payload_file(tmp_path / "a", {"A": [item("1"), item("1"), item("2", published="oops")]})
    second = payload_file(tmp_path / "b", {"A": [item("1"), item("3", published="2025-01-05T00:00:00Z")], "B": [item("1")]})
    added = [
        ingest.ingest_news(news.read_payloads(spark, path), store, since)
        for path, since in ((first, None), (second, None), (second, "2025-01-02"), (second, "2025-01-05"))
    ]
    assert added[:3] == [2, 2, 0]
    assert added[3] == 2  # the older rows were left out of the comparison
    spark.read.parquet(store).dropDuplicates(["content_id", "company_key"]).write.parquet(f"{store}_once", partitionBy="date")
    store = f"{store}_once"
    stored = landing.read_news(spark, store)
    assert rows(stored.select("content_id", "company_key", "date")) == [
        ("1", "A", date(2025, 1, 2)), ("1", "B", date(2025, 1, 2)), ("2", "A", None), ("3", "A", date(2025, 1, 5)),
    ]
    late = landing.read_news(spark, store, since="2025-01-03")
    assert [r["content_id"] for r in late.collect()] == ["3"]
    assert "PartitionFilters: [isnotnull(date" in plan_of(late)
    assert dict(stored.dtypes)["pubdate"] == "timestamp"


def test_nothing_stored_yet_is_empty_but_other_errors_show(spark, tmp_path):
    assert landing.read_or_empty(spark, str(tmp_path / "none"), schemas.NEWS).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="x.parquet"):
        landing.read_or_empty(spark, str(tmp_path / "bad"), schemas.NEWS).count()


def test_ledger_is_a_union(spark):
    keys = "content_id string, company_key string"
    old = spark.createDataFrame([("1", "A"), (None, "B")], keys)
    new = spark.createDataFrame([("2", "A"), (None, "B")], keys)
    assert rows(ingest.next_ledger(old, new)) == [("1", "A"), ("2", "A"), (None, "B")]
    assert ingest.next_ledger(None, new).count() == 2


def foreign_file(path, name, volume, unit):
    path.mkdir(parents=True, exist_ok=True)
    frame = pd.DataFrame(
        {
            "Datetime": pd.to_datetime(["2025-01-02 14:30:00.000000001", "2025-01-02 14:45:00"], utc=True, format="ISO8601"),
            "Open": [1.0, 2.0], "High": [1.0, 2.0], "Low": [1.0, 2.0], "Close": [1.0, 2.0],
            "Volume": volume, "Dividends": 0.0, "Stock Splits": 0.0, "Company_symbol": name,
        }
    )
    table = pa.Table.from_pandas(frame, preserve_index=False)
    field = table.schema.get_field_index("Datetime")
    stamps = table["Datetime"].cast(pa.timestamp(unit, "UTC"), safe=False)
    pq.write_table(table.set_column(field, "Datetime", stamps), path / f"{name}.parquet", row_group_size=1, version="2.6")


def test_foreign_files(spark, tmp_path):
    path = tmp_path / "foreign" / "2025-01-02"
    foreign_file(path, "A", [10, 20], "ns")
    foreign_file(path, "B", [10.0, None], "ns")
    foreign_file(path, "C", [5, 6], "us")
    (path / "README.txt").write_text("not data")
    got = landing.read_foreign_bars(spark, str(tmp_path / "foreign"), "company")
    assert got.schema.simpleString() == schemas.STOCK_COMPANY.simpleString()
    assert rows(got.select("company_symbol", "datetime", "volume")) == [
        ("A", T0, 10), ("A", T0 + timedelta(minutes=15), 20),
        ("B", T0, 10), ("B", T0 + timedelta(minutes=15), None),
        ("C", T0, 5), ("C", T0 + timedelta(minutes=15), 6),
    ]


def test_folder_prefixes(spark, tmp_path):
    for place in ("2025-01-02/1430/Company", "2025-01-02/1430/Sector", "2025-01-03/0900/Company"):
        (tmp_path / place).mkdir(parents=True)
        (tmp_path / place / "a.parquet").write_text("x")
        (tmp_path / place / "b.parquet").write_text("x")
    files = landing.landed_files(spark, str(tmp_path))
    found = landing.folder_prefixes(files, "Company")
    assert [r[0].split(tmp_path.name)[1] for r in found.orderBy("prefix").collect()] == [
        "/2025-01-02/1430/Company/", "/2025-01-03/0900/Company/",
    ]


def test_fetch_window(spark):
    some = spark.createDataFrame([(T0,)], "datetime timestamp")
    assert tuple(landing.fetch_window(some, "2025-02-01 00:00:00").first()) == ("incremental", T0)
    none = some.where("false")
    assert tuple(landing.fetch_window(none, "2025-02-01 00:00:00").first()) == ("bootstrap", at("2025-01-01 00:00:00"))


def test_fetch_bars(spark):
    bars = spark.createDataFrame(
        [(T0 - timedelta(minutes=15 * i), s, 1.0, 1.0, 1.0, 1.0, 1) for i in range(4) for s in ("A", "B")],
        schemas.STOCK_COMPANY,
    )
    keys = bars.select("company_symbol").distinct()
    now = T0 + timedelta(minutes=19, seconds=10)
    assert ingest.fetch_bars(bars, bars.where("false"), keys, "company", now).count() == 8
    assert ingest.fetch_bars(bars, bars, keys, "company", now).count() == 2
    some = bars.where(~((F.col("company_symbol") == "B") & (F.col("datetime") == T0)))
    with pytest.raises(bar_ops.DataNotFound, match="B: missing"):
        ingest.fetch_bars(some, bars, keys, "company", now)
    assert ingest.fetch_bars(some, bars, keys, "company", now, strict=False).count() == 1
    with pytest.raises(bar_ops.DataNotFound):
        ingest.fetch_bars(bars.where("false"), bars.where("false"), keys, "company", now)


def test_panel(spark):
    fields = ["Open", "Stock Splits"]
    panel = spark.createDataFrame(
        [(T0, 1.0, 0.0, None, None), (T0 + timedelta(minutes=15), 2.0, 0.0, 3.0, 0.0)],
        "datetime timestamp, `Open|A` double, `Stock Splits|A` double, `Open|BRK.B` double, `Stock Splits|BRK.B` double",
    )
    assert panels.panel_tickers(panel) == ["A", "BRK.B"]
    long = panels.panel_to_long(panel, fields, "company_symbol")
    assert "Exchange" not in plan_of(long)
    assert rows(long) == [
        (T0, "A", 1.0, 0.0), (T0, "BRK.B", None, None),
        (T0 + timedelta(minutes=15), "A", 2.0, 0.0), (T0 + timedelta(minutes=15), "BRK.B", 3.0, 0.0),
    ]
    assert rows(panels.long_to_panel(long, fields, "company_symbol", ["A", "BRK.B"])) == rows(panel)


SECTORS = [
    (0, "energy", "Energy", "^E", [("oil", "Oil", "^O", 0.6), ("gas", "Gas", "^G", 0.4)]),
    (1, "tech", "Tech", "^T", [("gas", "Gas again", "^G", 0.1), ("chips", "Chips", "^C", 0.9)]),
    (2, "energy", "Energy again", "^E", []),
]
INDUSTRIES = [
    (0, "oil", [("X", "Xx"), ("", "blank"), ("Y", "Yy"), (None, "none"), ("Z", "Zz"), ("W", "sixth")]),
    (1, "gas", [("X", "X in gas"), ("V", "Vv")]),
    (2, "chips", []),
    (3, "empty", None),
]


def test_master_data(spark):
    sectors = spark.createDataFrame(SECTORS, masterdata.SECTOR_RECORDS)
    records = spark.createDataFrame(INDUSTRIES, masterdata.INDUSTRY_RECORDS)
    assert rows(masterdata.sectors(sectors)) == [("energy", "Energy", "^E"), ("tech", "Tech", "^T")]
    assert rows(masterdata.industries(masterdata.industry_rows(sectors))) == [
        ("chips", "Chips", "^C", 0.9, "tech"), ("gas", "Gas", "^G", 0.4, "energy"), ("oil", "Oil", "^O", 0.6, "energy"),
    ]
    assert rows(masterdata.companies(masterdata.company_rows(records))) == [
        ("V", "Vv", "gas"), ("X", "Xx", "oil"), ("Y", "Yy", "oil"), ("Z", "Zz", "oil"),
    ]
    folder = session.scratch_dir(spark, "master")
    ingest.refresh_master(spark, sectors, records, "raw_master_test", folder)
    counts = ingest.refresh_master(spark, sectors, records.where("industry_pos = 1"), "raw_master_test", folder)
    assert counts == {"sector_info": 2, "industry_info": 3, "company_info": 2}
    assert rows(spark.table("raw_master_test.company_info").select("company_symbol")) == [("V",), ("X",)]
    assert spark.table("raw_master_test.industry_info").count() == 3


def test_keys(spark):
    assert masterdata.sector_keys(spark).count() == 11
    records = spark.createDataFrame(SECTORS, masterdata.SECTOR_RECORDS)
    assert ingest.followed(["tech"], records, "sector_key").count() == 1
    companies = spark.createDataFrame([("A", "a", "i"), (None, "b", "i")], schemas.COMPANY_INFO)
    assert rows(masterdata.company_symbols(companies)) == [("A",)]


def bars_frame(spark, *times, close=1.0):
    return spark.createDataFrame(
        [(t, "A", 1.0, 1.0, 1.0, close, 1) for t in times], schemas.STOCK_COMPANY
    )


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "d")
    days = bars_frame(spark, T0, T0 + timedelta(days=1)).withColumn("date", F.to_date("datetime"))
    sinks.write_dataset(days, path, "overwrite", ["date"])
    sinks.write_dataset(days, path, "append", ["date"])
    assert spark.read.parquet(path).count() == 4
    one = days.where(F.col("date") == "2025-01-02").withColumn("close", F.lit(9.0))
    sinks.write_dataset(one, path, "overwrite_partitions", ["date"])
    assert rows(spark.read.parquet(path).select("date", "close")) == [
        (date(2025, 1, 2), 9.0), (date(2025, 1, 3), 1.0), (date(2025, 1, 3), 1.0),
    ]
    sinks.write_dataset(one, path, "overwrite", ["date"])
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(ValueError):
        sinks.write_dataset(one, path, "upsert")
    with pytest.raises(ValueError):
        sinks.write_dataset(one, path, "overwrite_partitions")


def test_large_folder_is_written_by_many_tasks_and_a_small_one_by_few(spark, tmp_path):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "200KB")
    try:
        days = spark.range(0, 60_000, 1, 8).select(
            F.expr("if(id % 1000 = 0, date'2025-01-01' + cast(id / 6000 as int), date'2025-02-01')").alias("date"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"),
        )
        written = sinks.write_dataset(days, str(tmp_path / "d"), "overwrite", ["date"])
    finally:
        spark.conf.set(advisory, before)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "d").glob("date=*")}
    assert written == 60_000
    assert files.pop("date=2025-02-01") > 4
    assert max(files.values()) <= 2 and len(files) == 10


def test_land_and_save_cleaned(spark, tmp_path):
    landed, cleaned = str(tmp_path / "landed"), str(tmp_path / "cleaned")
    bars = bars_frame(spark, T0, T0 + timedelta(minutes=15))
    sinks.land_bars(bars, landed)
    assert (tmp_path / "landed" / "date=2025-01-02").is_dir()
    more = bars_frame(spark, T0, T0 + timedelta(minutes=30))
    assert sinks.land_bars(more.unionByName(more), landed) == 1  # copies and a retried bar are not added
    assert sinks.land_bars(more, landed) == 0
    assert spark.read.parquet(landed).count() == 3
    for close in (1.0, 2.0):
        sinks.save_cleaned(bars_frame(spark, T0, close=close), cleaned)
    sinks.save_cleaned(bars_frame(spark, T0 + timedelta(minutes=15)), cleaned)
    stored = spark.read.option("basePath", cleaned).parquet(cleaned)
    assert rows(stored.select("close")) == [(1.0,), (2.0,)]
    assert (tmp_path / "cleaned" / "date=2025-01-02" / "slot=1430").is_dir()


def test_slots_in_day_folders(spark, tmp_path):
    path = str(tmp_path / "days")
    day = timedelta(days=1)

    def stored():
        found = spark.read.schema(sinks.with_slot(bars_frame(spark, T0)).schema).parquet(path)
        return rows(found.select("datetime", "slot", "close"))

    sinks.save_cleaned_days(bars_frame(spark, T0, T0 + timedelta(minutes=15), T0 + day, None, close=1.0), path)
    other = (tmp_path / "days" / "date=2025-01-03")
    before = sorted(other.glob("*.parquet"))
    assert before and not list(tmp_path.glob("days/*/slot=*"))
    # one slot again, a new one, and bars without a time; the other slot of the day stays, other days are not touched
    assert sinks.save_cleaned_days(bars_frame(spark, T0, T0 + timedelta(minutes=30), None, close=2.0), path) == 4
    assert stored() == sorted([
        (T0, "1430", 2.0), (T0 + timedelta(minutes=15), "1445", 1.0), (T0 + timedelta(minutes=30), "1500", 2.0),
        (T0 + day, "1430", 1.0), (None, None, 2.0),
    ], key=str)
    assert sorted(other.glob("*.parquet")) == before
    assert sinks.save_cleaned_days(bars_frame(spark, T0).where("false"), path) == 0


def test_append_by_name(spark, tmp_path):
    sinks.ensure_table(spark, "by_name", schemas.STOCK_COMPANY, str(tmp_path / "t"))
    sinks.ensure_table(spark, "by_name", schemas.STOCK_COMPANY)
    odd = spark.createDataFrame([(2.5, "A", T0, "extra")], "CLOSE double, Company_Symbol string, DateTime timestamp, other string")
    sinks.append_by_name(odd, "by_name")
    assert rows(spark.table("by_name")) == [(T0, "A", None, None, None, 2.5, None)]
    more = bars_frame(spark, T0, T0 + timedelta(minutes=15))
    for _ in range(2):
        sinks.append_new(more.unionByName(more), "by_name", ["datetime", "company_symbol"])
    assert spark.table("by_name").count() == 2
    untimed = more.withColumn("datetime", F.lit(None).cast("timestamp")).limit(1)
    for _ in range(2):
        sinks.append_new(untimed, "by_name", ["datetime", "company_symbol"])
    assert spark.table("by_name").where("datetime is null").count() == 1


def test_full_refresh(spark, tmp_path):
    folder = str(tmp_path / "r")
    sinks.full_refresh(bars_frame(spark, T0), "refreshed", folder)
    twice = spark.table("refreshed").unionByName(bars_frame(spark, T0 + timedelta(days=1)))
    sinks.full_refresh(twice, "refreshed", folder)
    assert spark.table("refreshed").count() == 2
    sinks.full_refresh(spark.range(3), "refreshed", folder)  # other columns
    assert spark.table("refreshed").count() == 3
    with pytest.raises(ValueError):
        sinks.full_refresh(spark.range(3), "refreshed", "")


def test_load_bars_and_read_landed(spark, tmp_path):
    vendor = {ours: theirs for theirs, ours in schemas.LANDING_FIELDS.items()}
    landed = str(tmp_path / "stock")
    bars = bars_frame(spark, T0, T0 + timedelta(minutes=15)).withColumns(
        {"dividends": F.lit(0.0), "stock_splits": F.lit(0.0)}
    )
    bars.withColumnsRenamed(vendor).write.parquet(f"{landed}/2025-01-02/1430/Company")
    found = landing.read_landed_bars(spark, landed, "Company")
    assert found.columns[0] == "Datetime" and "Sector" not in found.columns
    for _ in range(2):
        ingest.load_bars(found, "Company", "loaded_bars", str(tmp_path / "table"))
    assert spark.table("loaded_bars").count() == 2


def test_kinds_under_one_root(spark, tmp_path):
    root = tmp_path / "company" / "stock"  # a folder above the root does not count
    frame = spark.createDataFrame([(T0, 1.0)], "Datetime timestamp, Open double")
    for place in ("2025-01-02/1430/Company", "2025-01-02/1430/Sector", "2025-01-02/1445/Sector", "kind=sector", "plain"):
        frame.write.parquet(f"{root}/{place}")
    count = lambda kind, *where: landing.read_landed_bars(spark, str(root), kind, *where).count()
    assert count("sector") == 4 and count("company") == 2
    assert count("sector", "2025-01-02") == 2 and count("sector", "2025-01-02", "1430") == 1
    assert count("company", "2025-01-02", "1445") == 0 and count("company", "2025-01-09") == 0
    plan = landing.read_landed_bars(spark, str(root), "company")._jdf.queryExecution().executedPlan()
    assert "Sector" not in str(plan.execute().toDebugString()) and plan.toString()


def test_unreadable_payloads(spark, tmp_path):
    good = '{"A": [{"content": {"id": "x", "pubDate": "2025-01-02T10:00:00Z"}}]}'
    payloads = spark.createDataFrame([(good,), ('{"A": [',), ('{"A": [',), ("",), (None,)], "payload string")
    store, kept = f"{tmp_path}/news", f"{tmp_path}/bad"
    with pytest.raises(ValueError):
        ingest.ingest_news(payloads, store)
    assert landing.read_news(spark, store).count() == 0
    assert [ingest.ingest_news(payloads, store, quarantine=kept) for _ in range(2)] == [1, 0]
    assert rows(spark.read.parquet(kept)) == [('{"A": [',)]


def test_a_load_of_nothing_readable_is_an_error(spark, tmp_path):
    cut = spark.createDataFrame([('{"A": [',)] * 9, "payload string")
    for payloads in (cut, cut.repartition(4), cut.limit(1)):
        with pytest.raises(ValueError):
            ingest.ingest_news(payloads, f"{tmp_path}/news")
    assert ingest.ingest_news(cut.where("payload = ''"), f"{tmp_path}/news") == 0


def test_bars_of_missed_runs_are_fetched(spark):
    bars = spark.createDataFrame(
        [(T0 + timedelta(minutes=15 * i), s, 1.0, 1.0, 1.0, 1.0, 1) for i in range(5) for s in ("A", "B")],
        schemas.STOCK_COMPANY,
    )
    keys = bars.select("company_symbol").distinct()
    landed = bars.where(F.col("datetime") == T0).withColumn("date", F.to_date("datetime"))
    now = T0 + timedelta(minutes=45 + 19)
    found = ingest.fetch_bars(bars, landed, keys, "company", now)
    assert found.count() == 6 and found.agg(F.max("datetime")).first()[0] == T0 + timedelta(minutes=45)
    # a first load names keys without any bar
    more = keys.unionByName(spark.createDataFrame([("C",)], keys.schema))
    with pytest.raises(bar_ops.DataNotFound, match="C: missing"):
        ingest.fetch_bars(bars, landed.where("false"), more, "company", now)


def test_nothing_landed_loads_nothing(spark, tmp_path):
    found = landing.read_landed_bars(spark, str(tmp_path / "none"), "sector")
    ingest.load_bars(found, "sector", "no_bars", str(tmp_path / "table"))
    assert spark.table("no_bars").count() == 0


def test_scratch_follows_the_cluster_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark, "x").startswith(f"{base}/x-")


def test_empty_writes_count_zero(spark, tmp_path):
    none = spark.createDataFrame([], schemas.STOCK_COMPANY)
    assert sinks.write_dataset(none, str(tmp_path / "a")) == 0
    assert sinks.land_bars(none, str(tmp_path / "b")) == 0
    assert sinks.full_refresh(none, "refreshed_empty", str(tmp_path / "c")) == 0
    assert spark.table("refreshed_empty").count() == 0


def test_foreign_reader_takes_gaps_and_absent_columns(spark, tmp_path):
    table = pa.table(
        {
            "Datetime": pa.array([T0, T0 + timedelta(minutes=15)], pa.timestamp("ns", "UTC")),
            **{name: [1.0, 2.0] for name in ("Open", "High", "Low", "Close")},
            "Volume": [float("nan"), 7.0],
            "Company_symbol": ["A", "A"],
        }
    )
    pq.write_table(table, tmp_path / "odd.parquet")
    got = landing.read_foreign_bars(spark, str(tmp_path), "company")
    assert rows(got.select("volume")) == [(7,), (None,)]


def odd_file(path, name, stamps, **columns):
    n = len(stamps)
    prices = {c: pa.array([1.0] * n) for c in ("Open", "High", "Low", "Close")}
    table = pa.table({"Datetime": stamps, **prices, "Company_symbol": pa.array([name] * n), **columns})
    path.mkdir(parents=True, exist_ok=True)
    pq.write_table(table, path / f"{name}.parquet", version="2.6")


def test_foreign_files_of_many_types_are_scans_of_spark(spark, tmp_path):
    """Before 1970, without a zone, as text, volume small, a float, absent or nothing but null; the filter reaches each scan."""
    old, late = at("1969-12-31 23:59:59.999999"), T0 + timedelta(minutes=30)
    utc = lambda *ts, unit="us", zone="UTC": pa.array([t.replace(tzinfo=None) for t in ts], pa.timestamp(unit, zone))
    root = tmp_path / "odd"
    odd_file(root / "a", "ns", pa.array([-1, 1_735_828_200_123_456_789], pa.timestamp("ns", "UTC")), Volume=pa.array([1, None], pa.int32()))
    odd_file(root / "b", "clock", utc(old, late, zone=None), Volume=pa.array([1.5, float("nan")], pa.float32()))
    odd_file(root / "c", "instant", utc(T0, late, unit="ms"))
    odd_file(root / "d", "text", pa.array(["2025-01-02T10:00:00-05:00", "no time"]), Volume=pa.nulls(2))
    got = landing.read_foreign_bars(spark, str(root), "company")
    assert rows(got.select("company_symbol", "datetime", "volume")) == sorted([
        ("ns", old, 1), ("ns", at("2025-01-02 14:30:00.123456"), None),
        ("clock", old, 1), ("clock", late, None),
        ("instant", T0, None), ("instant", late, None),
        ("text", at("2025-01-02 15:00:00"), None), ("text", None, None),
    ], key=str)
    plan = plan_of(got)
    assert plan.count("FileScan parquet") == 4 and "Python" not in plan and "Arrow" not in plan and "Dividends" not in plan
    later = landing.read_foreign_bars(spark, str(root), "company", since="2025-01-02 14:45:00")
    assert rows(later.select("company_symbol", "datetime")) == sorted([("clock", late), ("instant", late), ("text", at("2025-01-02 15:00:00"))], key=str)
    pushed = [line for line in plan_of(later).splitlines() if "FileScan" in line]
    assert sum("GreaterThanOrEqual(Datetime" in line for line in pushed) == 3


def test_foreign_files_of_one_type_are_read_by_folder(spark, tmp_path):
    for name in "AB":
        odd_file(tmp_path / name, name, pa.array([0], pa.timestamp("ns", "UTC")), Volume=pa.array([2]))
    got = landing.read_foreign_bars(spark, str(tmp_path), "company")
    assert rows(got.select("company_symbol", "volume")) == [("A", 2), ("B", 2)]
    assert "InMemoryFileIndex(1 paths)" in plan_of(got)


def test_scratch_folder_must_be_shared_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://somewhere:7077"

    with pytest.raises(ValueError):
        session.scratch_dir(Session, "x")


def test_slots_of_several_days_come_again(spark, monkeypatch):
    from sectorlens import registry
    from tests.helpers import TINY

    days = []

    def save(bars, path):
        days.append(bars.select(F.to_date("datetime")).distinct().count())
        registry.sinks.with_slot(bars).limit(0).write.mode("overwrite").parquet(path)

    monkeypatch.setattr(registry.sinks, "save_cleaned", save)
    registry.QUERIES["cleaned_slots_roundtrip"](spark, TINY)
    assert days[0] > days[1] > 10


def test_old_folders_of_a_table_expire(spark, tmp_path):
    place = tmp_path / "refreshed"
    try:
        for n in range(3):
            sinks.full_refresh(spark.range(n + 1), "expiring", str(place))
        sinks.full_refresh(spark.range(9), "expiring_too", str(place))
        (place / "expiring-notes").mkdir()
        (place / "other").mkdir()
        assert sinks.expire_folders(spark, "expiring", str(place), hours=1) == []
        gone = sinks.expire_folders(spark, "expiring", str(place), hours=0)
        assert len(gone) == 2 and not any((place / name).exists() for name in gone)
        assert spark.table("expiring").count() == 3 and spark.table("expiring_too").count() == 9
        assert sorted(p.name.split("-")[0] for p in place.iterdir()) == ["expiring", "expiring", "expiring_too", "other"]
        assert sinks.expire_folders(spark, "not_there", str(place), hours=0) == []
    finally:
        for table in ("expiring", "expiring_too"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
