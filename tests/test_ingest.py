import gzip
import json

import brokerage as b
import pytest
from pyspark.sql import functions as F

from ledgerlane.plans.daily import CUSTOMER_FIELDS, HOLDING_FIELDS, PRICE_FIELDS
from ledgerlane.sources import delimited as dl, files as fl, lines as ln
from ledgerlane.sources.sinks import append, unload_csv, with_defaults


@pytest.fixture
def holding_file(tmp_path):
    return b.write(tmp_path / "holdings.csv", b.holding_file_lines())


def test_bad_row_is_found_with_its_line(spark, holding_file):
    found = dl.validate_errors(spark, holding_file, HOLDING_FIELDS).collect()
    assert {r["column_name"] for r in found} == {"quantity", "avg_purchase_price", "purchase_date"}
    assert {r["line_no"] for r in found} == {32}
    assert found[0]["line"] == "C999,XXXX,NOT_A_NUMBER,abc,2024-13-99"


def test_clean_file_has_no_errors(spark, tmp_path):
    header = "customer_id,customer_name,risk_tolerance,contract_date,sales_rep"
    path = b.write(tmp_path / "customers.csv", [header] + b.lines(b.CUSTOMERS))
    assert dl.validate_errors(spark, path, CUSTOMER_FIELDS).count() == 0
    assert dl.load_rows(dl.tag_rows(spark, path, CUSTOMER_FIELDS)).count() == 10


def test_policies_and_report(spark, tmp_path, holding_file):
    good = b.write(tmp_path / "more.csv", b.holding_file_lines()[:11], "\n", True)
    tagged = dl.tag_rows(spark, [holding_file, good], HOLDING_FIELDS)
    loaded = dl.load_rows(tagged, dl.CONTINUE)
    assert loaded.count() == 40 and len(loaded.collect()) == 40
    assert dl.load_rows(tagged, dl.SKIP_FILE).count() == 10
    with pytest.raises(Exception, match="load aborted: value does not fit column quantity"):
        dl.load_rows(tagged, dl.ABORT).write.parquet(str(tmp_path / "never"))
    assert not list((tmp_path / "never").glob("*.parquet"))
    assert dl.load_rows(dl.tag_rows(spark, good, HOLDING_FIELDS), dl.ABORT).count() == 10
    with pytest.raises(ValueError):
        dl.load_rows(tagged, "ignore")
    report = {r["file_name"].rsplit("/", 1)[1]: r for r in dl.load_report(tagged).collect()}
    first, second = report["holdings.csv"], report["more.csv"]
    assert (first["row_parsed"], first["row_count"], first["error_count"], first["status"]) == (31, 30, 1, dl.PARTIAL)
    assert first["first_error_message"].startswith("value does not fit column quantity")
    assert (second["row_parsed"], second["error_count"], second["status"], second["first_error_message"]) == (10, 0, dl.LOADED, None)
    assert [r["file_name"].rsplit("/", 1)[1] for r in dl.load_report(tagged, failed_only=True).collect()] == ["holdings.csv"]


def test_skip_file_through_a_shuffle(no_broadcast, tmp_path, holding_file):
    good = b.write(tmp_path / "more.csv", b.holding_file_lines()[:11])
    assert dl.load_rows(dl.tag_rows(no_broadcast, [holding_file, good], HOLDING_FIELDS), dl.SKIP_FILE).count() == 10


def test_validate_rows(spark, tmp_path, holding_file):
    path = b.write(tmp_path / "prices.csv", b.price_file_lines())
    rows = dl.validate_rows(dl.tag_rows(spark, path, PRICE_FIELDS), 1).collect()
    assert len(rows) == 1 and rows[0]["stock_code"] == "7203" and rows[0]["closing_price"] == 1920
    with pytest.raises(Exception, match="load aborted"):
        dl.validate_rows(dl.tag_rows(spark, holding_file, HOLDING_FIELDS), 31).collect()


def test_validate_all_rows(spark, tmp_path, holding_file):
    path = b.write(tmp_path / "prices.csv", b.price_file_lines())
    assert dl.validate_rows(dl.tag_rows(spark, path, PRICE_FIELDS)).count() == len(b.price_file_lines()) - 1
    with pytest.raises(Exception, match="load aborted"):
        dl.validate_rows(dl.tag_rows(spark, holding_file, HOLDING_FIELDS)).collect()


def test_validated_group_is_whole(spark):
    from ledgerlane import workload

    sf = "/root/testdata/sf0.001"
    keys = [r[0] for r in spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderkey % 8 = 3").select("o_orderkey").collect()]
    got = workload.QUERIES["load_validate_rows"](spark, sf).collect()
    assert sorted(int(r.order_id) for r in got) == sorted(keys) and len(keys) > 7
    assert {r.checked for r in got} == {7} and {r.clean for r in got} == {workload.QUERIES["load_on_error_continue"](spark, sf).count()}


def test_rejects_and_repair(spark, holding_file):
    aside = dl.rejects(dl.tag_rows(spark, holding_file, HOLDING_FIELDS))
    row = aside.first()
    assert row["raw"] == ["C999", "XXXX", "NOT_A_NUMBER", "abc", "2024-13-99"]
    fixed = dl.repair(aside, HOLDING_FIELDS, {"stock_code": "0", "quantity": 0, "avg_purchase_price": 0, "purchase_date": "2024-01-01"}).first()
    assert (fixed["customer_id"], fixed["stock_code"], fixed["quantity"], str(fixed["purchase_date"])) == ("C999", "0", 0, "2024-01-01")
    with pytest.raises(ValueError):
        dl.repair(aside, HOLDING_FIELDS, {"nothing": 1})


def test_ragged_rows_quotes_and_empty_text(spark, tmp_path):
    path = b.write(tmp_path / "ragged.csv", ["a,b,c", '"x, ""y""",1,2', "short", "long,3,4,5,6", ",,", "bad,one,7"], "\n")
    spec = dl.fields(("a", "string"), ("b", "int"), ("c", "int"))
    fmt = dl.CsvFormat(escape='"')
    rows = {r["a"]: r for r in dl.tag_rows(spark, path, spec, fmt).collect()}
    assert (rows['x, "y"']["b"], rows['x, "y"']["c"]) == (1, 2)
    assert (rows["short"]["b"], rows["long"]["c"], rows["long"]["errors"]) == (None, 4, [])
    assert rows[None]["errors"] == [] and rows["bad"]["errors"] == ["b"]
    assert dl.load_rows(dl.tag_rows(spark, path, spec, fmt)).count() == 4


def test_line_numbers_over_many_blocks(spark, tmp_path):
    """Two files, cut into many blocks, CRLF and LF: every line gets its own number."""
    for name, n, newline in (("one.txt", 3000, "\r\n"), ("two.txt", 2777, "\n")):
        b.write(tmp_path / name, [f"{name} {i}" for i in range(1, n + 1)], newline, name == "two.txt")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        lines = ln.raw_lines(spark, str(tmp_path))
        index = ln.block_index(lines)
        assert index.count() > 10
        placed = ln.place_lines(lines, index)
        assert placed.count() == 5777
        assert placed.filter(F.split_part("line", F.lit(" "), F.lit(2)).cast("bigint") != F.col("line_no")).count() == 0
        part = ln.line_slice(spark, str(tmp_path / "one.txt"), 1500, 3).select("line").collect()
        assert sorted(r["line"] for r in part) == [f"one.txt {i}" for i in (1501, 1502, 1503)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_line_slice_of_the_rejected_end(spark, holding_file):
    rows = ln.line_slice(spark, holding_file, 30, 2).collect()
    assert sorted((r["line_no"], r["line"].split(",")[0]) for r in rows) == [(31, "C010"), (32, "C999")]
    assert ln.raw_lines(spark, holding_file).filter(F.col("line").startswith("customer_id")).count() == 1


def test_inspect_and_select_files(spark, tmp_path, holding_file):
    inferred = {r["column_name"]: r["type"] for r in dl.infer_csv_schema(spark, holding_file).collect()}
    assert inferred["quantity"] == "string" and list(inferred)[0] == "customer_id"
    assert dl.preview(spark, holding_file, 5, 3).count() == 3
    (tmp_path / "in").mkdir()
    for name in ("a_1.csv", "a_2.csv", "b_1.csv"):
        b.write(tmp_path / "in" / name, b.holding_file_lines()[:3])
    listed = fl.list_files(spark, str(tmp_path / "in"), r"a_\d\.csv$").collect()
    assert len(listed) == 2 and all(r["length"] > 0 for r in listed)
    assert dl.tag_rows(spark, str(tmp_path / "in"), HOLDING_FIELDS, pattern=r"a_\d[.]csv").count() == 4


def test_own_record_delimiter_and_reserved_names(spark, tmp_path):
    path = b.write(tmp_path / "semi.csv", ["a,n", "x,1", "y,bad"], ";")
    fmt, spec = dl.CsvFormat(record_delimiter=";"), dl.fields(("a", "string"), ("n", "int"))
    assert [(r["line_no"], r["line"]) for r in dl.validate_errors(spark, path, spec, fmt).collect()] == [(3, "y,bad")]
    assert [tuple(r) for r in dl.load_rows(dl.tag_rows(spark, path, spec, fmt)).collect()] == [("x", 1)]
    with pytest.raises(ValueError):
        dl.tag_rows(spark, path, dl.fields(("errors", "string")))


def test_compressed_and_piped(spark, tmp_path):
    with gzip.open(tmp_path / "x.csv.gz", "wt") as out:
        out.write(" a |1\n b |\n")
    fmt = dl.CsvFormat(delimiter="|", skip_header=False)
    assert [tuple(r) for r in dl.text_columns(spark, str(tmp_path), 2, fmt).collect()] == [(" a ", "1"), (" b ", None)]


def test_json_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"k": 1, "w": [{"m": "x"}]}, {"k": 2, "w": []}], indent=1))
    (tmp_path / "b.json").write_text(json.dumps([{"k": 3}]))
    got = fl.read_json_array(spark, str(tmp_path)).selectExpr("v:k::int AS k", "variant_get(v, '$.w[0].m', 'string') AS m").collect()
    assert sorted((r["k"], r["m"]) for r in got) == [(1, "x"), (2, None), (3, None)]


def test_append_and_unload(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, status string, amount decimal(12,2)").schema
    rows = spark.createDataFrame([(1,), (2,)], "a int")
    for _ in range(2):
        append(rows, str(tmp_path / "t"), schema, {"status": F.lit("OPEN")})
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert stored.count() == 4 and {r["status"] for r in stored.collect()} == {"OPEN"}
    with pytest.raises(ValueError):
        with_defaults(rows.withColumn("other", F.lit(1)), schema, {})
    for _ in range(2):
        unload_csv(rows, str(tmp_path / "out"), single=True)
    parts = list((tmp_path / "out").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text() == "1\n2\n"


def test_load_report_of_seventy_columns(spark, tmp_path):
    names = [f"c{k}" for k in range(70)]
    good, bad = ["1"] * 70, ["1"] * 70
    bad[3] = bad[65] = "x"
    (tmp_path / "wide.csv").write_text("\n".join(",".join(r) for r in (names, good, bad)) + "\n")
    tagged = dl.tag_rows(spark, str(tmp_path), dl.fields(*[(n, "int") for n in names]))
    r = dl.load_report(tagged).collect()[0]
    assert (r["row_parsed"], r["row_count"], r["error_count"]) == (2, 1, 1)
    assert "c3" in r["first_error_message"] and "c65" in r["first_error_message"]


def test_single_file_export_keeps_a_parallel_stage_and_the_order(spark, tmp_path):
    rows = spark.range(1_100_000, numPartitions=7).orderBy(F.col("id").desc())
    unload_csv(rows, str(tmp_path / "big"), single=True)
    parts = list((tmp_path / "big").glob("part-*"))
    lines = parts[0].read_text().split()
    assert len(parts) == 1 and lines == [str(k) for k in range(1_099_999, -1, -1)]


def test_single_file_with_header_and_gzip(spark, tmp_path):
    rows = spark.range(0, 1000, numPartitions=5).select("id", F.concat(F.lit('a "b", '), "id").alias("t")).orderBy(F.col("id").desc())
    unload_csv(rows, str(tmp_path / "z"), single=True, header=True, compression="gzip")
    (name,) = (tmp_path / "z").glob("part-*")
    with gzip.open(name, "rt") as source:
        lines = source.read().splitlines()
    assert lines[0] == "id,t" and [int(x.split(",")[0]) for x in lines[1:]] == list(range(999, -1, -1))
    with pytest.raises(ValueError):
        unload_csv(rows, str(tmp_path / "y"), single=True, compression="zstd")
    unload_csv(rows.limit(0), str(tmp_path / "z"), single=True)
    assert [p.read_text() for p in (tmp_path / "z").glob("part-*")] == [""]


def test_a_load_that_is_repeated_replaces_itself(spark, tmp_path):
    rows, path = spark.createDataFrame([(1,), (2,)], "a int"), str(tmp_path / "t")
    for load in ("x", "y", "x"):
        append(rows, path, rows.schema, load_id=load)
    assert spark.read.parquet(path).count() == 4
