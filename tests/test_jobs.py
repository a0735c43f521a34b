"""Streams against the batch answer, and the daily chain run twice."""

import datetime as dt
import os
import random
import shutil
from decimal import Decimal

import brokerage as b
import pytest
from pyspark.sql import functions as F

from ledgerlane.operators.layers import LayeredTable
from ledgerlane.plans import daily, portfolio as pf, runlog, trips as tp
from ledgerlane.sources import folders
from ledgerlane.sources.ledger import CHANGED, NEW, SAME, LoadLedger, loaded_rows
from ledgerlane.streaming import changefeed as cf
from ledgerlane.streaming.loader import load_new_files

FEED = "customer_id string, stock_code string, quantity decimal(10,0), avg_purchase_price decimal(12,2), seq bigint, deleted boolean"


def feed_rows():
    rows = [(c, s, Decimal(q), Decimal(p), 1, False) for c, s, q, p, _ in b.rows(b.HOLDINGS)[:30]]
    rows += [(c, s, q + 10, p, 2, False) for c, s, q, p, *_ in rows if c in ("C001", "C005")]
    rows += [(c, s, q, p, 3, True) for c, s, q, p, seq, _ in rows if c == "C008" and seq == 1]
    return rows


def final_holdings(spark):
    last = {}
    for r in sorted(feed_rows(), key=lambda r: r[4]):
        last[r[:2]] = r
    return spark.createDataFrame([r[:4] for r in last.values() if not r[5]], "customer_id string, stock_code string, quantity decimal(10,0), avg_purchase_price decimal(12,2)")


def write_feed(spark, path, rows, files=4):
    for i in range(files):
        spark.createDataFrame(rows[i::files], FEED).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(FEED).option("maxFilesPerTrigger", 1).parquet(path)


HOLDING = "customer_id string, stock_code string, quantity decimal(10,0), avg_purchase_price decimal(12,2)"


def feed_schema(spark):
    return spark.createDataFrame([], FEED).schema


def check_summaries(spark, summaries, holdings, customers, prices):
    want = pf.customer_summary(pf.positions(holdings, prices), customers)
    got = summaries.read_customers(spark).select(*want.columns)
    plain = lambda df: sorted(str([float(v) if isinstance(v, Decimal) else v for v in r]) for r in df.collect())
    assert plain(got) == plain(want)
    segments = summaries.read_segments(spark)
    assert plain(segments) == plain(pf.segment_summary(want).select(*segments.columns))
    return want


def test_refreshed_summary_equals_batch_for_any_order(spark, tmp_path):
    rows = feed_rows()
    random.Random(5).shuffle(rows)
    changes = write_feed(spark, str(tmp_path / "feed"), rows)
    summaries = cf.Summaries(str(tmp_path / "tables"), feed_schema(spark))
    dims = lambda: (b.customers(spark), b.prices(spark))
    cf.refresh_summary(changes, dims, summaries, str(tmp_path / "ck")).awaitTermination()
    want = check_summaries(spark, summaries, final_holdings(spark), *dims())
    assert want.filter("customer_id = 'C008'").count() == 0


def test_changed_prices_and_customers_wake_the_stream(spark, tmp_path):
    summaries = cf.Summaries(str(tmp_path / "tables"), feed_schema(spark))
    rows, dims = feed_rows(), [b.customers(spark), b.prices(spark)]
    ticks = [0]

    def run(part):
        """Either holdings come, or only word that a dimension changed."""
        if part:
            spark.createDataFrame(part, FEED).write.mode("append").parquet(str(tmp_path / "feed"))
        else:
            ticks[0] += 1
            spark.range(1).write.mode("append").parquet(str(tmp_path / "ticks"))
        feed = spark.readStream.schema(FEED).parquet(str(tmp_path / "feed"))
        words = spark.readStream.schema("id long").parquet(str(tmp_path / "ticks"))
        cf.refresh_summary(feed, lambda: tuple(dims), summaries, str(tmp_path / "ck"), words).awaitTermination()

    (tmp_path / "ticks").mkdir()
    run(rows[:30])
    check_summaries(spark, summaries, spark.createDataFrame([r[:4] for r in rows[:30]], HOLDING), *dims)
    # Prices move together with a batch that touches two or three customers only.
    dims[1] = dims[1].withColumn("closing_price", (F.col("closing_price") * 2).cast("decimal(12,2)"))
    run(rows[30:])
    check_summaries(spark, summaries, final_holdings(spark), *dims)
    # A customer, then a price, then a customer that leaves and one that comes, all without holdings.
    dims[0] = dims[0].withColumn("risk_tolerance", F.when(F.col("customer_id") == "C002", "other").otherwise(F.col("risk_tolerance")))
    run([])
    check_summaries(spark, summaries, final_holdings(spark), *dims)
    stock = rows[0][1]
    dims[1] = dims[1].filter(F.col("stock_code") != stock)
    run([])
    check_summaries(spark, summaries, final_holdings(spark), *dims)
    dims[1] = b.prices(spark)
    dims[0] = b.customers(spark).filter("customer_id <> 'C003'")
    run([])
    check_summaries(spark, summaries, final_holdings(spark), *dims)
    # Nothing changed: no row is written.
    written = summaries.totals
    run([])
    base, layers = written._stored(spark, None)
    assert written._read(spark, layers[-1]).count() == 0
    check_summaries(spark, summaries, final_holdings(spark), *dims)


def test_batches_write_what_changed(spark, tmp_path):
    """Small batches on a larger state: rows written follow the batch, repeated and late ones change nothing."""
    summaries = cf.Summaries(str(tmp_path / "tables"), feed_schema(spark))
    customers = spark.createDataFrame([(f"C{k}", f"n{k}", f"r{k % 3}") for k in range(300)], "customer_id string, customer_name string, risk_tolerance string")
    price_schema = "stock_code string, closing_price decimal(12,2), stock_name string, sector string, price_date date"
    prices = lambda n: spark.createDataFrame([(f"S{k}", Decimal(10 + k + (n if k == n % 40 else 0)), None, None, None) for k in range(40)], price_schema)
    held = {(f"C{k}", f"S{(7 * k + j) % 40}"): (Decimal(k + j + 1), Decimal(5 + j), 0, False) for k in range(300) for j in range(10)}
    summaries.refresh(spark.createDataFrame([(*k, *v) for k, v in held.items()], FEED), 0, customers, prices(0))
    random.seed(2)
    for n in range(1, 5):
        keys = random.sample(sorted(held), 3) + [(f"C{random.randrange(300)}", "S0")]
        batch = [(*k, Decimal(n), Decimal(7), n, random.random() < 0.3) for k in dict.fromkeys(keys)]
        late = [(*k, *held[k][:2], held[k][2] - 1, True) for k in random.sample(sorted(held), 2) if k not in keys]
        for k in batch:
            held[k[:2]] = k[2:]
        frame = spark.createDataFrame(batch + late, FEED)
        for _ in range(1 + (n == 3)):  # one batch comes twice
            summaries.refresh(frame, n, customers, prices(n))
        layer = lambda t: t._read(spark, next(a for a in t._stored(spark, None)[1] if a.last == n)).count()
        moved = {k[0] for k in batch} | {c for (c, s), v in held.items() if s in (f"S{n % 40}", f"S{(n - 1) % 40}")}
        assert layer(summaries.totals) <= len(moved) and layer(summaries.positions.table) == len(batch)
        assert layer(summaries.prices.table) == 2 - (n == 1) and layer(summaries.prices.digests) <= 2
    live = spark.createDataFrame([(*k, *v[:2]) for k, v in held.items() if not v[3]], HOLDING)
    check_summaries(spark, summaries, live, customers, prices(n))


def test_twenty_batches_leave_the_folder_flat(spark, tmp_path):
    state, sizes = cf.PositionState(str(tmp_path / "t"), feed_schema(spark)), []
    for n in range(21):
        rows = [(f"C{k}", f"S{j}", Decimal(n), Decimal(1), n, False) for k in range(200 if n == 0 else n % 7 + 1) for j in range(10)]
        state.take(spark.createDataFrame(rows, FEED), n)
        sizes.append(folders.size(spark, f"{tmp_path}/t"))
    assert max(sizes[10:]) < 1.5 * max(sizes[:10]) and len(folders.names(spark, f"{tmp_path}/t")) < 12
    assert state.live(spark).count() == 2000


def test_layers(spark, tmp_path):
    """Merges, buckets that follow the size, an index, half-written folders and NULL keys."""
    schema = spark.createDataFrame([], "k string, g int, v int").schema
    table = LayeredTable(str(tmp_path / "t"), schema, ["k"], "k", "g", bucket_bytes=2000)
    assert table.rows(spark).count() == 0
    want = {}
    for n in range(14):
        rows = [(f"k{j}" if j else None, j % 7, n) for j in range(0, 400 if n == 0 else 40, 1 + n % 5)]
        want.update({k: (g, v) for k, g, v in rows})
        table.merge(spark, n)
        table.write(spark.createDataFrame(rows, schema), n)
        (tmp_path / "t" / "layer-99-99-0").mkdir(exist_ok=True)  # without the mark of a finished job
        assert {r.k: (r.g, r.v) for r in table.rows(spark).collect()} == want
    base, layers = table._stored(spark, None)
    assert base.buckets > 1 and len(layers) < 8
    among = spark.createDataFrame([(3,)], "g int")
    assert {r.k for r in table.rows(spark, among=among).collect()} == {k for k, (g, _) in want.items() if g == 3}
    assert {r.k: r.v for r in table.rows(spark, among=spark.createDataFrame([("k5",), ("k399",)], "k string")).collect()} == {k: want[k][1] for k in ("k5", "k399")}
    assert table.rows(spark, 1).count() in (0, 400)  # what is below batch 1, unless merged already


def test_change_log_and_repeated_batch(spark, tmp_path):
    state = cf.PositionState(str(tmp_path / "state"), feed_schema(spark))
    rows = feed_rows()
    for part in (rows[:30], rows[30:]):
        spark.createDataFrame(part, FEED).write.mode("append").parquet(str(tmp_path / "feed"))
        feed = spark.readStream.schema(FEED).parquet(str(tmp_path / "feed"))
        cf.change_log_sink(feed, state, str(tmp_path / "log"), str(tmp_path / "ck")).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "log"))
    kinds = {(r["batch_id"], r["action"], r["is_update"]): r["count"] for r in log.groupBy("batch_id", "action", "is_update").count().collect()}
    assert kinds == {(0, "INSERT", False): 30, (1, "DELETE", True): 6, (1, "INSERT", True): 6, (1, "DELETE", False): 3}
    assert log.filter("change_timestamp IS NULL").count() == 0
    # The second batch once more gives the same changes, as it reads what is below it only.
    again = state.take(spark.createDataFrame(rows[30:], FEED), 1)
    assert again.count() == 9 and state.live(spark).count() == 27


def test_change_log_leaves_no_table_that_is_done_with(spark, tmp_path, monkeypatch):
    """Changes and the rows of a new base are removed once they are in the layers; a layer holds the new side once, the log is packed."""
    from ledgerlane.operators import layers

    written, whole = [], cf.materialize
    for part in (cf, layers):
        monkeypatch.setattr(part, "materialize", lambda df, label, **more: written.append(out := whole(df, label, **more)) or out)
    monkeypatch.setattr(layers, "MERGE_LAYERS", 1)
    state = cf.PositionState(str(tmp_path / "state"), feed_schema(spark))
    rows = feed_rows()
    for n, part in enumerate((rows[:30], rows[30:], rows[30:])):
        spark.createDataFrame(part, FEED).write.mode("append").parquet(str(tmp_path / "feed"))
        feed = spark.readStream.schema(FEED).parquet(str(tmp_path / "feed"))
        cf.change_log_sink(feed, state, str(tmp_path / "log"), str(tmp_path / "ck")).awaitTermination()
    files = [f.removeprefix("file://") for df in written for f in df.inputFiles()]
    assert len(written) >= 4 and not [f for f in files if os.path.exists(f)]
    assert all("__new" not in spark.read.parquet(str(p)).columns for p in (tmp_path / "state").glob("layer-*"))
    assert all(".zstd." in p.name for p in (tmp_path / "log").rglob("part-*"))
    assert state.live(spark).count() == 27


def test_day_is_merged_by_keys(spark, tmp_path, monkeypatch):
    """Whole rows of the old day are not joined with the new ones; rows aside are removed; a NULL key finds its row; a repeated key fails."""
    from ledgerlane.operators import tables as tb

    written, whole = {}, tb.materialize
    for part in (daily, tb):
        monkeypatch.setattr(part, "materialize", lambda df, label, **more: written.setdefault((label, len(written)), whole(df, label, **more)))
    path, day, clock = str(tmp_path / "t"), F.lit("2026-03-11").cast("date"), [F.lit(f"2026-03-11 0{h}:00:00").cast("timestamp") for h in range(3)]
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int").withColumn("d", day)
    daily.upsert_day(path, frame([("a", 1), ("b", 2), (None, 3)]), ["d", "k"], "d", day, clock[0])
    daily.upsert_day(path, frame([("z", 9)]).withColumn("d", F.date_add(day, 1)), ["d", "k"], "d", F.date_add(day, 1), clock[0])
    got = daily.upsert_day(path, frame([("b", 5), (None, None), ("c", 7)]), ["d", "k"], "d", day, clock[1])
    assert {(r.k, r.v, r.load_timestamp.hour) for r in got.collect()} == {("a", 1, 0), ("b", 5, 1), (None, None, 1), ("c", 7, 1)} and got.count() == 4
    assert {r.d for r in spark.read.parquet(path).filter("k = 'z'").collect()} == {dt.date(2026, 3, 12)}
    assert {label for label, _ in written} == {"day-rows", "left-keys", "staged"} and all(df.columns == ["__left_d", "__left_k"] for (label, _), df in written.items() if label == "left-keys")
    assert not [f for df in written.values() for f in df.inputFiles() if os.path.exists(f.removeprefix("file://"))]
    with pytest.raises(Exception, match="several source rows for key d=2026-03-11, k=b"):
        daily.upsert_day(path, frame([("b", 5), ("b", 6)]), ["d", "k"], "d", day, clock[2])


def test_files_are_loaded_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    b.write(tmp_path / "in" / "a.csv", b.price_file_lines())

    def load():
        load_new_files(spark, str(tmp_path / "in"), daily.PRICE_FIELDS, str(tmp_path / "t"), str(tmp_path / "log"), str(tmp_path / "ck"), "MARKET_PRICES").awaitTermination()
        return spark.read.parquet(str(tmp_path / "t")).count()

    assert load() == 30 and load() == 30
    b.write(tmp_path / "in" / "b.csv", b.price_file_lines()[:4] + ["1,n,s,2026-03-11,abc,1,1,1"])
    assert load() == 33
    log = spark.read.parquet(str(tmp_path / "log")).collect()
    assert [(r["affected_rows"], r["details"].rsplit("/", 1)[1]) for r in log] == [(30, "a.csv")]


def test_daily_chain_twice(spark, tmp_path):
    prices = b.write(tmp_path / "prices.csv", b.price_file_lines())
    tables = daily.DailyTables(str(tmp_path / "db"))
    args = (b.holdings(spark), b.customers(spark), b.targets(spark), b.AS_OF)
    first = daily.run_day(spark, tables, prices, *args, dt.datetime(2026, 3, 11, 18)).collect()
    assert len(first) == 24 and first[0]["sales_rep"] == "佐藤三郎"
    # Second run of the day without C008: its rows stay, alerts are closed and issued again.
    left = args[0].filter("customer_id <> 'C008'")
    daily.run_day(spark, tables, None, left, *args[1:], dt.datetime(2026, 3, 11, 19))
    snapshot = spark.read.parquet(tables.path("portfolio_snapshot"))
    assert snapshot.count() == 30
    stamps = {r["load_timestamp"].hour: r["count"] for r in snapshot.groupBy("load_timestamp").count().collect()}
    assert stamps == {18: 3, 19: 27}
    assert spark.read.parquet(tables.path("customer_allocation")).count() == 25
    status = {r["alert_status"]: r["count"] for r in spark.read.parquet(tables.path("rebalance_alerts")).groupBy("alert_status").count().collect()}
    assert status == {"CLOSED": 24, "OPEN": 24}
    log = spark.read.parquet(tables.path("run_log")).orderBy("check_timestamp").collect()
    assert len(log) == 9
    entries = sorted((r["check_type"], r["affected_rows"]) for r in log)
    assert entries == sorted([("DAILY_LOAD", 30)] + 2 * [("DAILY_UPDATE", 30), ("DAILY_UPDATE", 25), ("ALERT_GENERATION", 24), ("EMAIL_PREPARATION", 3)])
    assert any(r["details"] == "Generated 24 alerts for date: 2026-03-11" for r in log)
    assert any(r["details"] == "Prepared email alerts for 3 sales representatives" for r in log)
    # Another day leaves the first one alone.
    next_day = dt.date(2026, 3, 12)
    daily.run_day(spark, tables, None, *args[:3], next_day, dt.datetime(2026, 3, 12, 18))
    per_day = {str(r["snapshot_date"]): r["record_count"] for r in pf.snapshot_check(spark.read.parquet(tables.path("portfolio_snapshot"))).collect()}
    assert per_day == {"2026-03-11": 30, "2026-03-12": 30}


def test_files_are_known_by_the_ledger(spark, tmp_path):
    """The same file twice, under a new time, with other content, and a run that is repeated or broke off."""
    tables, name = daily.DailyTables(str(tmp_path / "db")), b.write(tmp_path / "p.csv", b.price_file_lines())
    ledger = LoadLedger(tables.path("load_ledger"))

    def load(run, files=name):
        found = {r.file.rsplit("/", 1)[1]: r.state for r in daily.load_prices(spark, tables, files, run, dt.datetime(2026, 3, 11)).collect()}
        return found, loaded_rows(spark, tables.path("market_prices"), ledger).count()

    assert load("r1") == ({"p.csv": NEW}, 30) and load("r1") == ({"p.csv": NEW}, 30)
    assert load("r2") == ({"p.csv": SAME}, 30)
    os.utime(tmp_path / "p.csv", (1, 1))
    assert load("r3") == ({"p.csv": SAME}, 30)
    later = [x.replace("2026-03-11", "2026-03-12").replace(",1920,", ",2000,") for x in b.price_file_lines()]
    b.write(tmp_path / "p.csv", later)
    assert load("r4") == ({"p.csv": CHANGED}, 30)
    b.write(tmp_path / "q.csv", later[:6])
    # A load that broke off before its entries left rows that nobody reads.
    shutil.copytree(tmp_path / "db" / "market_prices" / "load_id=r1", tmp_path / "db" / "market_prices" / "load_id=broken")
    assert load("r5", [name, str(tmp_path / "q.csv")]) == ({"p.csv": CHANGED, "q.csv": NEW}, 35)
    latest = {r.stock_code: str(r.price_date) for r in daily.latest_prices(tables).rows(spark).collect()}
    assert len(latest) == 30 and sorted(latest.values()).count("2026-03-12") == 5
    assert sorted(r.number for r in ledger.entries(spark).collect()) == [1, 2]
    assert sorted(p.name for p in (tmp_path / "db" / "market_prices" / "load_id=r5").glob("price_date=*")) == ["price_date=2026-03-12"]


def test_a_repeated_run_replaces_its_rows_and_log(spark, tmp_path):
    prices = b.write(tmp_path / "prices.csv", b.price_file_lines())
    tables = daily.DailyTables(str(tmp_path / "db"))
    args = (b.holdings(spark), b.customers(spark), b.targets(spark), b.AS_OF, dt.datetime(2026, 3, 11, 18))
    for _ in range(2):
        assert len(daily.run_day(spark, tables, prices, *args).collect()) == 24
        assert loaded_rows(spark, tables.path("market_prices"), LoadLedger(tables.path("load_ledger"))).count() == 30
        assert spark.read.parquet(tables.path("run_log")).count() == 5


def test_trips_by_condition_counts_like_a_join(spark):
    base = dt.datetime(2018, 1, 1, 10)
    trips = spark.createDataFrame([(base + dt.timedelta(minutes=7 * i),) for i in range(40)], "starttime timestamp")
    seen = spark.createDataFrame(
        [(base, "Rain"), (base + dt.timedelta(minutes=30), "Rain"), (base + dt.timedelta(minutes=70), "Snow"), (base + dt.timedelta(minutes=75), None)],
        "observation_time timestamp, weather string")
    got = {r["conditions"]: r["num_trips"] for r in tp.trips_by_condition(trips, seen).collect()}
    plain = trips.join(seen, F.date_trunc("hour", "starttime") == F.date_trunc("hour", "observation_time")).filter("weather IS NOT NULL").groupBy("weather").count()
    assert got == {r["weather"]: r["count"] for r in plain.collect()}


def test_run_log_views(spark):
    t = dt.datetime(2024, 1, 10, 18)
    log = spark.createDataFrame(
        [("LOAD", "SUCCEEDED", t, t + dt.timedelta(seconds=30), None, None), ("LOAD", "FAILED", t + dt.timedelta(hours=1), t + dt.timedelta(hours=1, seconds=5), "1", "x"),
         ("MAIL", "EXECUTING", t + dt.timedelta(hours=2), None, None, None), ("LOAD", "SKIPPED", t - dt.timedelta(days=30), t - dt.timedelta(days=30), None, None)],
        "name string, state string, scheduled_time timestamp, completed_time timestamp, error_code string, error_message string")
    rows = runlog.run_history(log, F.lit(t + dt.timedelta(days=1))).collect()
    assert [(r["task_name"], r["status_display"], r["execution_seconds"]) for r in rows] == [("MAIL", "EXECUTING", None), ("LOAD", "❌ 失敗", 5), ("LOAD", "✅ 成功", 30)]
    day = runlog.run_summary(log, F.lit(t.date())).first()
    assert (day["total_executions"], day["successful"], day["failed"], day["skipped"], float(day["avg_execution_seconds"])) == (3, 1, 1, 0, 17.5)
    assert runlog.last_runs(log, "LOAD").count() == 3 and runlog.runs_on(log, F.lit(t.date())).count() == 3
