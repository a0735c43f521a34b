"""Streams over a change feed made from the holdings; the SQL twins compute the end state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import discard, materialize, workspace
from ..sources import folders
from ..streaming import changefeed as cf
from .registry import query
from .roles import POS, Roles, dbl, mean, pct

BATCHES = 3

# Feed: every position is inserted (batch 1), every third gets one share more (batch 2), every
# seventh is deleted (batch 3). A late copy of the first change arrives in batch 3 and must lose.
_FEED = f"""{POS},
live AS (SELECT p.*, quantity + CASE WHEN stock_code % 3 = 0 THEN 1 ELSE 0 END AS q FROM pos p WHERE stock_code % 7 <> 0),
summary AS (
  SELECT c.customer_id, c.customer_name, c.risk_tolerance, count(*) AS stock_count, sum(q * avg_purchase_price) AS total_investment,
    sum(q * current_price) AS total_current_value
  FROM live l JOIN customers c ON l.customer_id = c.customer_id GROUP BY c.customer_id, c.customer_name, c.risk_tolerance),
with_return AS (SELECT *, {pct('total_current_value - total_investment', 'total_investment')} AS overall_return_pct FROM summary)"""


def write_feed(r: Roles) -> tuple[str, StructType]:
    stock = F.col("stock_code")
    base = materialize(r.holdings.select("customer_id", "stock_code", "quantity", "avg_purchase_price"), "holdings")
    more = (F.col("quantity") + F.when(stock % 3 == 0, 1).otherwise(0)).cast("decimal(10,0)")

    def change(seq: int, rows: DataFrame, deleted: bool = False) -> DataFrame:
        return rows.withColumns({"seq": F.lit(seq).cast("bigint"), "deleted": F.lit(deleted)})

    updated = base.filter(stock % 3 == 0).withColumn("quantity", more)
    removed = base.filter(stock % 7 == 0).withColumn("quantity", more)
    late = change(1, base.filter(stock % 21 == 0))
    path = workspace(r.spark, "feed")
    for rows in (change(1, base), change(2, updated), change(3, removed, True).unionByName(late)):
        rows.write.mode("append").parquet(path)
    discard(base)
    return path, r.spark.read.parquet(path).schema


def _stream(r: Roles) -> tuple[DataFrame, StructType, int]:
    """The feed as a stream, its schema, and the number of batches it comes in."""
    path, schema = write_feed(r)
    files = r.spark.read.format("binaryFile").load(path).count()
    per_batch = max(1, -(-files // BATCHES))
    return r.spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path), schema, -(-files // per_batch)


def _dims_at(r: Roles, stage: int) -> tuple[DataFrame, DataFrame]:
    """Customers and prices as they move: at first all differ from the end, then every fourth, then none."""
    def before(key: str, name: str, value):
        return F.when((F.col(key) % 4 == 0) | F.lit(stage == 0), value).otherwise(F.col(name)) if stage < 2 else F.col(name)

    price, risk = F.col("closing_price"), F.col("risk_tolerance")
    return (
        r.customers.withColumn("risk_tolerance", before("customer_id", "risk_tolerance", F.concat(F.lit("OLD "), risk))),
        r.prices.withColumn("closing_price", before("stock_code", "closing_price", price + 7).cast("decimal(12,2)")))


def _refresh(r: Roles, trigger: dict | None = None) -> cf.Summaries:
    """Customers and prices change after the first batch, and once more when all holdings are in; then only the stream
    that tells of their changes has something new."""
    changes, schema, batches = _stream(r)
    base = workspace(r.spark, "refresh")
    for _ in range(batches + 1):
        r.spark.range(1).coalesce(1).write.mode("append").parquet(f"{base}/ticks")
    ticks = r.spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{base}/ticks")
    summaries = cf.Summaries(f"{base}/tables", schema)
    stages = iter([0] + [1] * (batches - 1))
    job = cf.refresh_summary(changes, lambda: _dims_at(r, next(stages, 2)), summaries, f"{base}/checkpoint", ticks, trigger)
    if trigger is None:
        job.awaitTermination()
    else:
        job.processAllAvailable()
        job.stop()
    return summaries


@query("inc_customer_summary", f"""{_FEED}
SELECT customer_id, customer_name, risk_tolerance, stock_count, {dbl('total_investment')} AS total_investment,
  {dbl('total_current_value')} AS total_current_value, overall_return_pct FROM with_return""")
def inc_customer_summary(r: Roles) -> DataFrame:
    return _refresh(r).read_customers(r.spark)


@query("inc_segment_summary", f"""{_FEED}
SELECT risk_tolerance, count(*) AS customer_count, {mean('sum(CAST(overall_return_pct AS DECIMAL(28,2)))', 'count(overall_return_pct)')} AS avg_return_pct,
  {dbl('sum(total_investment)')} AS total_investment, {dbl('sum(total_current_value)')} AS total_current_value FROM with_return GROUP BY risk_tolerance""")
def inc_segment_summary(r: Roles) -> DataFrame:
    return _refresh(r).read_segments(r.spark)


@query("inc_refresh_lag", f"""{_FEED} SELECT count(*) AS customers, CAST(sum(stock_count) AS BIGINT) AS positions FROM with_return""")
def inc_refresh_lag(r: Roles) -> DataFrame:
    """The same refresh under a processing-time trigger, the freshness target of the table."""
    summary = _refresh(r, {"processingTime": "1 second"}).read_customers(r.spark)
    return summary.agg(F.count(F.lit(1)).alias("customers"), F.sum("stock_count").alias("positions"))


@query("inc_change_log", f"""{POS},
moves AS (
  SELECT 'INSERT' AS action, FALSE AS is_update, customer_id, stock_code, quantity FROM pos
  UNION ALL SELECT 'DELETE', TRUE, customer_id, stock_code, quantity FROM pos WHERE stock_code % 3 = 0
  UNION ALL SELECT 'INSERT', TRUE, customer_id, stock_code, quantity + 1 FROM pos WHERE stock_code % 3 = 0
  UNION ALL SELECT 'DELETE', FALSE, customer_id, stock_code, quantity + CASE WHEN stock_code % 3 = 0 THEN 1 ELSE 0 END FROM pos WHERE stock_code % 7 = 0)
SELECT action, is_update, customer_id, stock_code, CAST(quantity AS DOUBLE) AS quantity, TRUE AS stamped FROM moves""")
def inc_change_log(r: Roles) -> DataFrame:
    """All rows of the log: every position comes, every third changes, every seventh goes; late copies leave no row."""
    path, schema = write_feed(r)
    base = workspace(r.spark, "changelog")
    state = cf.PositionState(f"{base}/state", schema)
    # One stage of the feed a batch, so that no step is netted away.
    for stage in range(1, 4):
        rows = r.spark.read.parquet(path).filter((F.col("seq") == stage) if stage < 3 else (F.col("seq") == 3) | ((F.col("seq") == 1) & (F.col("stock_code") % 21 == 0)))
        rows.write.mode("append").option("compression", "zstd").parquet(f"{base}/feed/stage={stage}")
        if stage == 3:
            folders.remove(r.spark, path)
        feed = r.spark.readStream.schema(schema).parquet(f"{base}/feed/stage=*")
        cf.change_log_sink(feed, state, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    log = r.spark.read.parquet(f"{base}/log")
    return log.select("action", "is_update", "customer_id", "stock_code", "quantity", F.col("change_timestamp").isNotNull().alias("stamped"))
