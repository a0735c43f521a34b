import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlane.operators import changes as ch, joins, quality as q, reshape, tables as tb
from ledgerlane.operators.distinct import distinct_counts
from ledgerlane.operators.latest import top_per_key
from ledgerlane.operators.versions import VersionedTable
from ledgerlane.sources import folders

NOW = dt.datetime(2024, 5, 1, 12)
OLD = dt.datetime(2024, 4, 1, 12)


def values(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def frame(spark, rows, schema="k int, v string"):
    return spark.createDataFrame(rows, schema)


# ---- keyed updates -------------------------------------------------------------------------


def test_upsert_updates_inserts_and_never_deletes(spark):
    old = frame(spark, [(1, "a", OLD), (2, "b", OLD), (3, "c", OLD)], "k int, v string, load_timestamp timestamp")
    new = frame(spark, [(2, None), (4, "d")])
    merged = tb.upsert(old, new, ["k"], ("load_timestamp", F.lit(NOW)))
    want = [(1, "a", OLD), (2, None, NOW), (3, "c", OLD), (4, "d", NOW)]
    assert values(merged) == want
    assert values(tb.upsert(merged, new, ["k"], ("load_timestamp", F.lit(NOW)))) == want


def test_update_and_delete_treat_null_as_no(spark):
    df = frame(spark, [(1, "a"), (2, None), (3, "c")])
    assert values(tb.update_where(df, F.col("v") == "a", {"v": F.lit("z")})) == [(1, "z"), (2, None), (3, "c")]
    assert values(tb.delete_where(df, F.col("v") == "a")) == [(2, None), (3, "c")]
    assert values(tb.update_where(df, F.lit(True), {"v": F.lit("oops")}), "v") == [("oops",)] * 3


def test_insert_if_absent(spark):
    old = frame(spark, [(1, "a")])
    assert values(tb.insert_if_absent(old, frame(spark, [(1, "new"), (2, "b")]), ["k"])) == [(1, "a"), (2, "b")]


LOG = [(1, 1, "INSERT", "a"), (2, 1, "INSERT", "b"), (1, 2, "UPDATE", "a2"), (2, 3, "DELETE", "b"), (3, 4, "INSERT", "c"), (1, 5, "UPDATE", "oops"), (2, 6, "INSERT", "back")]


def test_versions_and_rollback(spark):
    log = frame(spark, LOG, "k int, version int, op string, v string")
    states = {v: values(tb.state_before(log, ["k"], v)) for v in (1, 2, 3, 4, 5, 7)}
    assert states == {1: [], 2: [(1, "a"), (2, "b")], 3: [(1, "a2"), (2, "b")], 4: [(1, "a2")], 5: [(1, "a2"), (3, "c")], 7: [(1, "oops"), (2, "back"), (3, "c")]}
    undo = tb.rollback(log, ["k"], 5, 7)
    assert values(undo, "k", "op") == [(1, "UPDATE"), (2, "DELETE")]
    assert values(tb.state_before(log.unionByName(undo), ["k"], 8)) == states[5]


def test_replace_partitions_reads_and_writes_one_path(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [(1, "a"), (2, "b")]).write.partitionBy("k").parquet(path)
    grown = spark.read.parquet(path).filter("k = 2").unionByName(frame(spark, [(2, "c")]))
    tb.replace_partitions(grown, path, ["k"])
    assert values(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "b"), (2, "c")]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tb.publish_new(grown, path)


# ---- net changes ---------------------------------------------------------------------------


@pytest.mark.parametrize("old, new, want", [
    ([(1, "a")], [(1, "a")], []),
    ([], [(1, "a")], [("INSERT", False, "a")]),
    ([], [(1, "final")], [("INSERT", False, "final")]),
    ([(1, "a")], [(1, "b")], [("DELETE", True, "a"), ("INSERT", True, "b")]),
    ([(1, "a")], [(1, None)], [("DELETE", True, "a"), ("INSERT", True, None)]),
    ([(1, "a")], [], [("DELETE", False, "a")]),
    ([], [], []),
])
def test_net_changes(spark, old, new, want):
    got = ch.net_changes(frame(spark, old), frame(spark, new), ["k"])
    assert values(got, "action", "is_update", "v") == sorted(want, key=str)


def test_changes_applied_to_old_give_new(spark):
    old = spark.range(0, 100).select("id", (F.col("id") % 7).alias("v"))
    new = spark.range(10, 120).select("id", (F.col("id") % 5).alias("v"))
    changes = ch.net_changes(old, new, ["id"])
    assert values(ch.apply_changes(old, changes, ["id"])) == values(new)
    assert ch.net_changes(new, new, ["id"]).count() == 0
    assert changes.filter("is_update").groupBy("row_id").count().filter("count <> 2").count() == 0


# ---- joins ---------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(no_broadcast, how):
    """A third of all rows has one key; NULL keys and keys without partner are there as well."""
    rows = no_broadcast.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"))
    dim = no_broadcast.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).unionByName(no_broadcast.createDataFrame([(7, 99)], "k bigint, w bigint"))
    spread, plain = joins.spread_join(rows, dim, ["k"], how), rows.join(dim, ["k"], how)
    assert values(spread.select(*plain.columns)) == values(plain)
    assert "__salt" not in spread.columns
    with pytest.raises(ValueError):
        joins.spread_join(rows, dim, ["k"], "full_outer")


def test_group_total_with_hot_groups(no_broadcast):
    """The same result whether no, some or all groups count as hot."""
    rows = no_broadcast.range(2000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k"))
    totals = rows.groupBy("k").agg(F.sum("id").alias("t"))
    want = values(rows.join(totals, "k").select("id", "k", "t"))
    for limit in (1, 200, 10_000):
        assert values(joins.with_group_total(rows, "id", ["k"], "t", limit).select("id", "k", "t")) == want
    counts = joins.key_counts(rows, ["k"])
    assert values(joins.hot_keys(counts, ["k"], min_rows=200)) == [(7,)]
    assert joins.hot_keys(counts, ["k"], min_rows=10_000) is None


def test_table_checks_equal_single_checks(spark):
    df = frame(spark, [(1, "a"), (1, None), (2, "c"), (2, "d"), (3, None)])
    both = q.table_checks(df, "T", ["v"], ["k"])
    single = q.null_check(df, "T", ["v"]).unionByName(q.duplicate_check(df, "T", ["k"]))
    assert values(both) == values(single)


def test_hot_key_goes_to_many_tasks(no_broadcast):
    rows = no_broadcast.range(2000).select("id", F.lit(1).alias("k"))
    dim = no_broadcast.createDataFrame([(1, "x")], "k int, w string")
    no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = joins.spread_join(rows, dim, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        no_broadcast.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1


def test_three_orphan_definitions(spark):
    child = frame(spark, [(1,), (1,), (9,), (9,), (None,)], "k int")
    parent = frame(spark, [(1,), (2,)], "k int")
    with_null = frame(spark, [(1,), (None,)], "k int")
    none = frame(spark, [], "k int")
    assert q.fk_check(child, "T", "k", parent, "k").first()["affected_rows"] == 3
    assert q.fk_check(child, "T", "k", parent, "k", distinct=True).first()["affected_rows"] == 2
    for parents, want in ((parent, 2), (with_null, 0), (none, 5)):
        assert q.fk_metric(child, "T", "k", parents, "k", F.lit(NOW)).first()["value"] == want
    spark.catalog.clearCache()
    child.createOrReplaceTempView("c1"), parent.createOrReplaceTempView("p1"), with_null.createOrReplaceTempView("p2"), none.createOrReplaceTempView("p3")
    for view, want in (("p1", 2), ("p2", 0), ("p3", 5)):
        assert spark.sql(f"SELECT * FROM c1 WHERE k NOT IN (SELECT k FROM {view})").count() == want


# ---- checks and metrics --------------------------------------------------------------------


def test_checks_and_report(spark):
    df = frame(spark, [(1, "a"), (1, None), (2, "c"), (2, "d"), (3, "e")])
    log = q.check_log([q.null_check(df, "T", ["k", "v"]), q.duplicate_check(df, "T", ["k"]), q.null_check(df, "T", ["k"])], F.lit(NOW))
    got = values(log, "check_type", "check_result", "affected_rows")
    assert got == [("DUPLICATE_CHECK", "FAIL", 2), ("NULL_CHECK", "FAIL", 1), ("NULL_CHECK", "PASS", 0)]
    assert q.report(log, failed_only=True).count() == 2 and q.report(log).count() == 3
    assert values(q.row_counts({"A": df, "B": df.limit(0)})) == [("A", 5), ("B", 0)]


def test_metric_suite(spark):
    df = frame(spark, [(1, OLD), (1, NOW), (2, OLD), (None, OLD)], "k int, t timestamp")
    suite = q.Suite().attach("T", "NULL_COUNT", "k").attach("T", "UNIQUE_COUNT", "k").attach("T", "DUPLICATE_COUNT", "k").attach("T", "ROW_COUNT").attach("T", "FRESHNESS", "t")
    suite.attach_fk("T", "k", "P", "k")
    got = dict(values(suite.run({"T": df, "P": frame(spark, [(1,)], "k int")}, F.lit(NOW + dt.timedelta(minutes=2))), "metric_name", "value"))
    assert got == {"NULL_COUNT": 1, "UNIQUE_COUNT": 2, "DUPLICATE_COUNT": 1, "ROW_COUNT": 4, "FRESHNESS": 120, "FK_EXISTS": 1}
    assert suite.listing(spark).count() == 6
    assert suite.detach("T", "ROW_COUNT").listing(spark).count() == 5
    with pytest.raises(ValueError):
        suite.attach("T", "MEDIAN", "k")


# ---- lists, pivots, ranks ------------------------------------------------------------------


def test_text_list_of_a_hot_group(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5).cast("string")).alias("g"), F.lpad((F.col("id") % 900).cast("string"), 4, "0").alias("name"))
    got = {r["g"]: r["names"] for r in reshape.text_list(rows.repartition(7), ["g"], "name", "names").collect()}
    want = {}
    for r in rows.distinct().collect():
        want.setdefault(r["g"], []).append(r["name"])
    assert got == {g: ", ".join(sorted(names)) for g, names in want.items()}


def test_pivots(spark):
    df = frame(spark, [(1, "a", 3), (1, "b", 1), (2, None, 5), (2, "c", 5)], "k int, s string, n int")
    fixed = values(reshape.fixed_pivot(df, ["k"], "s", {"a": "a", "b": "b"}, F.col("n"), "rest"))
    assert fixed == [(1, 3, 1, 0, 4), (2, 0, 0, 5, 10)]
    assert values(reshape.max_pivot(df, ["k"], "s", {"a": "a", "c": "c"}, "n")) == [(1, 3, None), (2, None, 5)]
    shares = values(reshape.share_pivot(df, ["k"], "s", "n"))
    assert [[float(x) for x in r] for r in shares] == [[1, 75, 25, 0], [2, 0, 0, 100]]
    with pytest.raises(ValueError):
        reshape.distinct_values(spark.range(5).withColumn("s", F.col("id").cast("string")), "s", limit=3)


def test_top_per_key(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), "id")
    assert values(top_per_key(df, ["g"], ["id"], 2)) == [(0, 96), (0, 99), (1, 94), (1, 97), (2, 95), (2, 98)]


def test_null_keys_match_themselves(spark):
    rows = spark.createDataFrame([(1, None, 5), (1, "a", 6), (None, "b", 7)], "c int, s string, v int")
    again = tb.upsert(rows, rows.withColumn("v", F.col("v") + 1), ["c", "s"])
    assert sorted(r["v"] for r in again.collect()) == [6, 7, 8]
    assert tb.insert_if_absent(rows, rows, ["c", "s"]).count() == 3


def test_pivot_wider_than_a_thousand_values(spark):
    df = spark.range(1500).select(F.lit(1).alias("k"), F.concat(F.lit("v"), "id").alias("s"), F.lit(2).alias("n"))
    assert len(reshape.distinct_values(df, "s")) == 1500
    shares = reshape.share_rows(df, ["k"], "s", "n", 4).collect()
    assert len(shares) == 1500 and {float(r["share"]) for r in shares} == {0.0667}


def test_hot_keys_leave_out_a_null_in_any_key(spark):
    counts = spark.createDataFrame([(1, None, 500), (1, 2, 500), (None, 2, 500)], "a int, b int, n long")
    assert values(joins.hot_keys(counts, ["a", "b"], min_rows=100)) == [(1, 2)]


def test_consuming_moves_the_stored_offset_and_reading_does_not(spark, tmp_path):
    path, columns = str(tmp_path / "orders"), "k int, v string"

    def opened():
        return ch.ConsumedChanges(path, ["k"])

    def events(df):
        return sorted((r.k, r.v, r.action, r.is_update) for r in df.collect())

    opened().publish(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], columns))
    assert opened().offset(spark) == 1 and events(opened().pending(spark)) == []
    opened().publish(spark.createDataFrame([(1, "a"), (2, "c")], columns))
    opened().publish(spark.createDataFrame([(1, "a"), (2, "d"), (4, "e")], columns))
    want = sorted([(2, "b", "DELETE", True), (2, "d", "INSERT", True), (3, None, "DELETE", False), (4, "e", "INSERT", False)], key=str)
    for _ in range(2):
        assert sorted(events(opened().pending(spark)), key=str) == want
        assert opened().offset(spark) == 1 and opened().logged(spark).count() == 0
    opened().consume(spark)
    assert opened().offset(spark) == 3 and events(opened().pending(spark)) == []
    opened().consume(spark)
    # A version without changes is consumed as well.
    opened().publish(spark.createDataFrame([(4, "e"), (2, "d"), (1, "a")], columns))
    opened().consume(spark)
    assert opened().offset(spark) == 4
    opened().publish(spark.createDataFrame([(4, "e"), (2, "d")], columns))
    assert events(opened().pending(spark)) == [(1, "a", "DELETE", False)]
    opened().consume(spark)
    logged = sorted((r.version, r.k, r.v, r.action) for r in opened().logged(spark).filter("k <> 3").collect())
    assert logged == [(3, 2, "b", "DELETE"), (3, 2, "d", "INSERT"), (3, 4, "e", "INSERT"), (5, 1, "a", "DELETE")]


def test_repeated_source_keys_fail_with_the_key(spark):
    old, new = frame(spark, [(1, "a")]), frame(spark, [(2, "x"), (2, "y"), (3, "z")])
    with pytest.raises(Exception, match="several source rows for key k=2"):
        tb.upsert(old, new, ["k"]).collect()
    with pytest.raises(Exception, match="several source rows for key k=NULL"):
        tb.upsert(old, frame(spark, [(None, "x"), (None, "x")]), ["k"]).collect()


def test_stored_delete_removes_emptied_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a b/c", 1), (2, "a b/c", 2), (3, "d", 3), (4, None, 4), (5, "e", 5)]
    frame(spark, rows, "k int, g string, h int").write.partitionBy("g").parquet(path)
    tb.delete_stored(spark, path, (F.col("k") <= 2) | (F.col("k") == 4), ["g"])
    assert values(spark.read.parquet(path), "k", "g") == [(3, "d"), (5, "e")]
    assert [n for n in folders.names(spark, path) if "=" in n] == ["g=d", "g=e"]
    tb.delete_stored(spark, path, F.col("k") == 99, ["g"])
    tb.delete_stored(spark, path, F.lit(None).cast("boolean"), ["g"])
    assert spark.read.parquet(path).count() == 2


def test_versioned_table(spark, tmp_path):
    """The same states as from the log; as-of and rollback read intervals, not the log."""
    log = frame(spark, LOG, "k int, version int, op string, v string")
    table = VersionedTable(str(tmp_path / "v"), frame(spark, []).schema, ["k"])
    for version in range(1, 7):
        for _ in range(1 + version % 2):  # a version that is written again replaces itself
            table.apply(log.filter(F.col("version") == version), version)
    states = {v: values(tb.state_before(log, ["k"], v)) for v in range(1, 8)}
    assert {v: values(table.as_of(spark, v)) for v in range(1, 8)} == states
    assert "Window" not in table.as_of(spark, 4)._jdf.queryExecution().toString()
    undo = table.rollback(spark, 5, 7)
    assert values(undo, "k", "op") == [(1, "UPDATE"), (2, "DELETE")]
    assert values(table.current(spark)) == states[5] == values(table.as_of(spark, 8))
    assert values(table.as_of(spark, 7)) == states[7] and values(table.as_of(spark, 2)) == states[2]
    loaded = VersionedTable(str(tmp_path / "loaded"), table.schema, ["k"])
    loaded.load(log.filter("version < 4"))
    for version in range(4, 7):
        loaded.apply(log.filter(F.col("version") == version), version)
    assert {v: values(loaded.as_of(spark, v)) for v in range(1, 8)} == states
    with pytest.raises(ValueError):
        loaded.load(log)
    table.rollback(spark, 1, 8)
    assert values(table.current(spark)) == [] and values(table.as_of(spark, 8)) == states[5]


def test_digests_find_the_parts_that_differ(spark, tmp_path):
    base = spark.range(4000).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id").cast("string")).alias("v"), F.lit(None).cast("string").alias("w"))
    base = base.withColumn("w", F.when(F.col("k") == 6, "x"))
    # Few keys change; one row only moves its value into the other, NULL, column.
    new = base.filter("k <> 17").withColumns({"v": F.when(F.col("k") == 6, "x").when(F.col("k") == 40, "new").otherwise(F.col("v")), "w": F.when(F.col("k") == 6, None).otherwise(F.col("w"))})
    new = new.unionByName(spark.createDataFrame([(9000, None, None)], new.schema))
    want = values(ch.net_changes(base, new, ["k"]))
    assert len(want) == 6 and values(ch.net_changes_by_digest(base, new, ["k"], 64)) == want == values(ch.net_changes_by_digest(base, new, ["k"], 1))
    assert ch.net_changes_by_digest(base, base, ["k"]).count() == 0
    one, two = (ch._by_part(ch.part_digests(df, ["k"], 256)) for df in (base, new))
    assert len([p for p in one.keys() | two.keys() if one.get(p) != two.get(p)]) <= 4
    consumed = ch.ConsumedChanges(str(tmp_path / "c"), ["k"])
    consumed.publish(base)
    consumed.publish(new)
    assert values(consumed.pending(spark)) == want
    plan = consumed.pending(spark)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and plan.count(f"{ch.PART}#") and " IN (" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_metric_store_equals_a_full_scan(spark, tmp_path):
    """Runs over added files, a repeated run, an empty file, and a file that is replaced."""
    import shutil

    from ledgerlane.operators.metric_store import MetricStore

    spec = [("ROW_COUNT", None), ("NULL_COUNT", "v"), ("UNIQUE_COUNT", "v"), ("DUPLICATE_COUNT", "v"), ("FRESHNESS", "t")]
    store, path = MetricStore(str(tmp_path / "m"), "T", spec), str(tmp_path / "t")
    schema, now = "v int, t timestamp", dt.datetime(2024, 5, 1, 13)

    def add(rows, folder="a"):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{path}/part={folder}")

    def check(run):
        got = {(r.metric_name, r.column_name): r.value for r in store.run(spark, path, run, now).collect()}
        full = {(r.metric_name, r.column_name): r.value for r in q.metrics(spark.read.parquet(path), "T", spec, F.lit(now)).collect()}
        assert got == full
        return store._states(spark, run + 1).filter(F.col("run") == run).filter("file IS NOT NULL").select("file").distinct().count()

    add([(1, OLD), (1, OLD), (None, OLD), (2, NOW)])
    assert check(1) == 1
    add([(2, OLD), (3, None), (None, None)], "b")
    add([], "b")
    assert check(2) == 2 and check(2) == 2  # only what is new; a repeated run replaces itself
    assert check(3) == 0
    shutil.rmtree(tmp_path / "t" / "part=a")
    add([(9, OLD)], "c")
    assert check(4) == 3  # a counted file is gone: from the beginning
    trend = {r.metric_name: (r.value, r.previous) for r in store.trend(spark).collect()}
    assert trend["ROW_COUNT"] == (4, 7) and store.history(spark).count() == 20


@pytest.mark.parametrize("bitmaps", [None, False])
def test_distinct_counts_without_expand(spark, bitmaps):
    rows = [(g, k % n if k % 5 else None, f"s{k % 3}") for g, n in (("a", 7), ("b", 50_000), (None, 1)) for k in range(200)]
    rows += [("c", None, None), ("a", -(1 << 40), "x"), ("a", (1 << 62), "x"), ("a", -1, None), ("a", 0, None)]
    df = spark.createDataFrame(rows, "g string, n long, s string")
    got = distinct_counts(df, ["g"], {"numbers": "n", "texts": "s"}, bitmaps)
    assert "Expand" not in got._jdf.queryExecution().toString()
    assert values(got) == values(df.groupBy("g").agg(F.count_distinct("n"), F.count_distinct("s")))
