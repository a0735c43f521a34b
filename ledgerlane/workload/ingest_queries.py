"""File loading. Every query writes the orders (or events) to files first, some rows spoiled by
key arithmetic, and then loads those files; its SQL twin works on the table itself."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from ..functions.semistructured import at
from ..operators.tables import read_or_empty
from ..session import materialize, workspace
from ..sources import delimited as dl, files as fl, lines as ln
from ..streaming.loader import load_new_files
from .registry import query
from .roles import Roles, dbl

SPEC = dl.fields(
    ("order_id", "string"), ("customer_id", "bigint"), ("price", "decimal(12,2)"), ("order_date", "date"), ("status", "string"))
GROUPS = 8

# Text columns as written to the files. Every 29th price is no number, every 31st date no date;
# group 3 has no bad row. An empty text is NULL.
_TEXT = f"""text_rows AS (
  SELECT o_orderkey % {GROUPS} AS part, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN o_orderkey % {GROUPS} <> 3 AND o_orderkey % 29 = 0 THEN 'NOT_A_NUMBER' WHEN o_orderkey % 37 = 0 THEN NULL
      ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
    CASE WHEN o_orderkey % {GROUPS} <> 3 AND o_orderkey % 31 = 0 THEN '1996-13-99' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    o_orderstatus || ', "' || o_orderpriority || '"' AS status FROM orders),
typed AS (
  SELECT part, order_id, TRY_CAST(customer_id AS BIGINT) AS customer_id, TRY_CAST(price AS DECIMAL(12,2)) AS price, TRY_CAST(order_date AS DATE) AS order_date,
    status, price AS raw_price, order_date AS raw_date,
    price IS NOT NULL AND TRY_CAST(price AS DECIMAL(12,2)) IS NULL AS bad_price, order_date IS NOT NULL AND TRY_CAST(order_date AS DATE) IS NULL AS bad_date
  FROM text_rows)"""
_ROW = f"order_id, customer_id, {dbl('price')} AS price, CAST(order_date AS VARCHAR) AS order_date, status"
_GOOD = "NOT bad_price AND NOT bad_date"
_WHY = """'value does not fit column ' || CASE WHEN bad_price AND bad_date THEN 'price, order_date' WHEN bad_price THEN 'price' ELSE 'order_date' END"""


def order_text(r: Roles) -> DataFrame:
    key = F.col("o_orderkey")
    spoil = key % GROUPS != 3
    price = F.when(spoil & (key % 29 == 0), "NOT_A_NUMBER").when(key % 37 != 0, F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    date = F.when(spoil & (key % 31 == 0), "1996-13-99").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return r.table("orders").select(
        (key % GROUPS).alias("part"), key.cast("string").alias("order_id"), F.col("o_custkey").cast("string").alias("customer_id"),
        price.alias("price"), date.alias("order_date"), F.concat("o_orderstatus", F.lit(', "'), "o_orderpriority", F.lit('"')).alias("status"))


def write_orders(r: Roles, in_order: bool = False) -> str:
    """CSV files in one folder per group, with header lines. Each task writes its own files; ``in_order`` gives one file a group, by order."""
    path = workspace(r.spark, "csv")
    rows = order_text(r)
    if in_order:
        rows = rows.repartition("part").sortWithinPartitions("part", F.col("order_id").cast("bigint"))
    rows.write.partitionBy("part").option("header", True).option("escape", '"').csv(path)
    return path


def _paths(path: str) -> list[str]:
    return [f"{path}/part={i}" for i in range(GROUPS)]


def tagged(r: Roles) -> DataFrame:
    return dl.tag_rows(r.spark, _paths(write_orders(r)), SPEC)


def folder(column: str):
    return F.regexp_extract(column, r"part=(\d+)/", 1).cast("bigint")


@query("src_infer_schema", "SELECT * FROM (VALUES (1, 'order_id', 'int'), (2, 'customer_id', 'int'), (3, 'price', 'string'), (4, 'order_date', 'string'), (5, 'status', 'string')) AS t(position, column_name, type)")
def src_infer_schema(r: Roles) -> DataFrame:
    """One bad row turns a column into text; that is why this is for a look only."""
    return dl.infer_csv_schema(r.spark, write_orders(r) + "/part=*").drop("nullable")


@query("src_preview", f"""WITH {_TEXT}
SELECT order_id, customer_id, price, order_date, status FROM text_rows WHERE part = 1 ORDER BY CAST(order_id AS BIGINT) LIMIT 10""")
def src_preview(r: Roles) -> DataFrame:
    """The first ten rows of a file that is in the order of its keys, as text."""
    return dl.preview(r.spark, _paths(write_orders(r, in_order=True))[1], 5, 10).toDF("order_id", "customer_id", "price", "order_date", "status")


@query("src_raw_lines", f"""WITH {_TEXT}
SELECT sha256(order_id || ',' || customer_id || ',' || coalesce(price, '') || ',' || order_date || ',"' || replace(status, '"', '""') || '"') AS v, count(*) AS n FROM text_rows GROUP BY 1""")
def src_raw_lines(r: Roles) -> DataFrame:
    """Whole lines; the header is left out for the comparison."""
    body = ln.raw_lines(r.spark, _paths(write_orders(r))).filter(~F.col("line").startswith("order_id,"))
    return body.groupBy(F.sha2("line", 256).alias("v")).agg(F.count(F.lit(1)).alias("n"))


@query("src_line_slice", f"WITH {_TEXT} SELECT order_id, customer_id FROM text_rows")
def src_line_slice(r: Roles) -> DataFrame:
    """Line 2 to the end of every file: exactly the data rows, without the header lines."""
    path = workspace(r.spark, "numbered")
    order_text(r).select("order_id", "customer_id").write.option("header", True).csv(path)
    rows = ln.line_slice(r.spark, path, 1, 1 << 40)
    return rows.select(F.split_part("line", F.lit(","), F.lit(1)).alias("order_id"), F.split_part("line", F.lit(","), F.lit(2)).alias("customer_id"))


@query("src_typed_csv", f"WITH {_TEXT} SELECT {_ROW} FROM typed")
def src_typed_csv(r: Roles) -> DataFrame:
    return tagged(r).select(*[f.name for f in SPEC])


@query("src_csv_options", """
SELECT CAST(p_partkey AS VARCHAR) AS id, ' ' || p_name || '|"' || p_brand || '"' || CASE WHEN p_partkey % 11 = 0 THEN chr(10) ELSE ' ' END AS label,
  CASE WHEN p_partkey % 3 <> 0 THEN p_type || CASE WHEN p_partkey % 2 = 0 THEN '|x' || chr(92) ELSE '' END END AS kind, CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS VARCHAR) END AS size FROM part""")
def src_csv_options(r: Roles) -> DataFrame:
    """Delimiter, doubled quotes and line breaks in quotes, escapes outside of quotes, blanks kept, empty text as NULL, short rows, gzip files."""
    key = F.col("p_partkey")
    quoted = F.concat(F.lit('" '), "p_name", F.lit('|""'), "p_brand", F.lit('""'), F.when(key % 11 == 0, "\n").otherwise(" "), F.lit('"'))
    kind = F.concat("p_type", F.when(key % 2 == 0, "\\|x\\\\").otherwise(""))
    line = F.concat_ws("|", key.cast("string"), quoted, F.when(key % 3 != 0, kind).otherwise(""))
    line = F.when(key % 5 != 0, F.concat(line, F.lit("|"), F.col("p_size").cast("string"))).otherwise(line)
    path = workspace(r.spark, "piped")
    r.table("part").select(line.alias("value")).write.option("compression", "gzip").text(path)
    fmt = dl.CsvFormat(delimiter="|", skip_header=False)
    return dl.text_columns(r.spark, path, 4, fmt).toDF("id", "label", "kind", "size")


@query("src_pattern", f"WITH {_TEXT} SELECT part, count(*) AS n FROM text_rows WHERE part IN (1, 2, 5) GROUP BY part")
def src_pattern(r: Roles) -> DataFrame:
    rows = dl.tag_rows(r.spark, _paths(write_orders(r)), SPEC, pattern=r"part=[125]/.*[.]csv")
    return rows.groupBy(folder("file").alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("src_list_files", f"WITH {_TEXT} SELECT part, TRUE AS has_files FROM text_rows WHERE part <> 4 GROUP BY part")
def src_list_files(r: Roles) -> DataFrame:
    found = fl.list_files(r.spark, write_orders(r), r"part=[^4]/.*\.csv$")
    return found.groupBy(folder("path").alias("part")).agg((F.min("length") > 0).alias("has_files"))


@query("src_json_array", "SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def src_json_array(r: Roles) -> DataFrame:
    """Events in array files of at most 5000 elements each, one file per array."""
    body = F.to_json(F.struct("event_id", "user_id", "event_type", F.from_json("props", "k int").alias("props")))
    arrays = (
        r.table("events").groupBy(F.floor(F.col("event_id") / 5000).alias("chunk"))
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list(body), ",\n"), F.lit("\n]")).alias("value"))
    )
    path = workspace(r.spark, "json")
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    v = fl.read_json_array(r.spark, path)
    return v.select(
        at("v", "$.event_id", "bigint").alias("event_id"), at("v", "$.user_id", "bigint").alias("user_id"),
        at("v", "$.event_type", "string").alias("event_type"), at("v", "$.props.k", "int").alias("k"))


@query("src_incremental_files", f"""WITH {_TEXT}
SELECT part, count(*) AS loaded FROM typed WHERE {_GOOD} GROUP BY part""")
def src_incremental_files(r: Roles) -> DataFrame:
    """A stream over the folders: started twice, every file is loaded once."""
    path, base = write_orders(r), workspace(r.spark, "incremental")
    for _ in range(2):
        job = load_new_files(
            r.spark, f"{path}/part=*", dl.fields(*[(f.name, f.type) for f in SPEC]), f"{base}/table", f"{base}/log", f"{base}/checkpoint", "ORDERS")
        job.awaitTermination()
    good = r.spark.read.parquet(f"{base}/table")
    return good.groupBy((F.col("order_id").cast("bigint") % GROUPS).alias("part")).agg(F.count(F.lit(1)).alias("loaded"))


# ---- validation and error handling ---------------------------------------------------------


@query("load_validate_errors", f"""WITH {_TEXT},
numbered AS (SELECT *, 1 + row_number() OVER (PARTITION BY part ORDER BY CAST(order_id AS BIGINT)) AS line_no FROM typed)
SELECT part, line_no, order_id, 'price' AS column_name, 'value does not fit column price' AS message FROM numbered WHERE bad_price
UNION ALL SELECT part, line_no, order_id, 'order_date', 'value does not fit column order_date' FROM numbered WHERE bad_date""")
def load_validate_errors(r: Roles) -> DataFrame:
    """Bad values with their lines in files that are in the order of their keys."""
    found = dl.validate_errors(r.spark, _paths(write_orders(r, in_order=True)), SPEC)
    return found.select(folder("file").alias("part"), "line_no", F.substring_index("line", ",", 1).alias("order_id"), "column_name", "message")


@query("load_validate_rows", f"""WITH {_TEXT},
looked_at AS (SELECT order_id FROM typed WHERE part = 3 LIMIT 7)
SELECT {_ROW}, (SELECT count(*) FROM looked_at) AS checked, (SELECT count(*) FROM typed WHERE {_GOOD}) AS clean FROM typed WHERE part = 3""")
def load_validate_rows(r: Roles) -> DataFrame:
    """All rows of the clean group, converted, next to the number of rows of a first look and of the clean rows of all groups."""
    paths = _paths(write_orders(r))
    group = dl.tag_rows(r.spark, paths[3], SPEC)
    looked_at = dl.validate_rows(group, 7).agg(F.count(F.lit(1)))
    clean = dl.good_rows(dl.tag_rows(r.spark, paths, SPEC)).agg(F.count(F.lit(1)))
    return dl.validate_rows(group).withColumn("checked", looked_at.scalar()).withColumn("clean", clean.scalar())


@query("load_on_error_continue", f"WITH {_TEXT} SELECT {_ROW} FROM typed WHERE {_GOOD}")
def load_on_error_continue(r: Roles) -> DataFrame:
    return dl.load_rows(tagged(r), dl.CONTINUE)


@query("load_on_error_abort", f"""WITH {_TEXT}
SELECT 'clean' AS load, {_ROW} FROM typed WHERE part = 3
UNION ALL SELECT 'value does not fit column', NULL, NULL, NULL, NULL, NULL""")
def load_on_error_abort(r: Roles) -> DataFrame:
    """All or nothing: the load of all files meets a bad row, fails and leaves nothing; the load of the clean group is whole."""
    paths, target = _paths(write_orders(r)), workspace(r.spark, "abort")
    try:
        dl.load_rows(dl.tag_rows(r.spark, paths, SPEC), dl.ABORT).write.parquet(f"{target}/all")
        said = "not aborted"
    except PySparkException as error:
        said = "value does not fit column" if "load aborted: value does not fit column" in str(error) else str(error)
    dl.load_rows(dl.tag_rows(r.spark, paths[3], SPEC), dl.ABORT).write.parquet(f"{target}/clean")
    clean = r.spark.read.parquet(f"{target}/clean").withColumn("load", F.lit("clean"))
    left = read_or_empty(r.spark, f"{target}/all", clean.drop("load").schema).withColumn("load", F.lit("all"))
    aborted = r.spark.createDataFrame([(said,)], "load string")
    return clean.unionByName(left).unionByName(aborted, allowMissingColumns=True).select("load", *[f.name for f in SPEC])


@query("load_on_error_skip_file", f"""WITH {_TEXT}, broken AS (SELECT DISTINCT part FROM typed WHERE bad_price OR bad_date)
SELECT {_ROW} FROM typed WHERE part NOT IN (SELECT part FROM broken)""")
def load_on_error_skip_file(r: Roles) -> DataFrame:
    """Files are the unit here, so the folder of a group stands for its file."""
    rows = tagged(r).withColumn("file", F.regexp_extract("file", r"(part=\d+)/", 1))
    return dl.load_rows(rows, dl.SKIP_FILE)


_REPORT = f"""WITH {_TEXT}, counted AS (SELECT part, count(*) AS row_parsed, count(CASE WHEN {_GOOD} THEN 1 END) AS row_count,
  count(CASE WHEN NOT ({_GOOD}) THEN 1 END) AS error_count FROM typed GROUP BY part)
SELECT 'part=' || CAST(part AS VARCHAR) AS file_name, row_parsed, row_count, error_count, error_count > 0 AS has_message,
  CASE WHEN error_count = 0 THEN 'LOADED' WHEN row_count = 0 THEN 'LOAD_FAILED' ELSE 'PARTIALLY_LOADED' END AS status FROM counted"""


@query("load_report", _REPORT)
def load_report(r: Roles) -> DataFrame:
    report = dl.load_report(tagged(r), by=F.regexp_extract("file", r"(part=\d+)/", 1))
    return report.withColumn("has_message", F.col("first_error_message").isNotNull()).drop("first_error_message")


@query("load_quarantine", f"""WITH {_TEXT}
SELECT order_id, raw_price, raw_date, {_WHY} AS message FROM typed WHERE NOT ({_GOOD})""")
def load_quarantine(r: Roles) -> DataFrame:
    """Rejected rows written aside with their raw values."""
    aside = materialize(dl.rejects(tagged(r)), "rejects")
    return aside.select(F.col("raw")[0].alias("order_id"), F.col("raw")[2].alias("raw_price"), F.col("raw")[3].alias("raw_date"), "message")


@query("load_repair_rejects", f"""WITH {_TEXT}
SELECT order_id, customer_id, CAST(0 AS DOUBLE) AS price, '2024-01-01' AS order_date, status FROM typed WHERE NOT ({_GOOD})""")
def load_repair_rejects(r: Roles) -> DataFrame:
    return dl.repair(dl.rejects(tagged(r)), SPEC, {"price": 0, "order_date": "2024-01-01"})
