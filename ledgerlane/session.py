"""Session set-up and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What every job here relies on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
PARTITION_BYTES = 128 << 20


def shuffle_start(input_bytes: int) -> int:
    """Shuffle partitions to start with for an input size; adaptive execution merges what is too small.

    100 TB gives 50,000, the upper end; below 25 GB it is Spark's default of 200.
    """
    return min(50_000, max(200, input_bytes // PARTITION_BYTES))


def build_session(app: str = "ledgerlane", master: str | None = None, input_bytes: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``input_bytes`` sizes the shuffles for a large run."""
    settings = dict(SETTINGS)
    if input_bytes:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_start(input_bytes))
        settings["spark.sql.shuffle.partitions"] = str(shuffle_start(input_bytes))
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that all executors share.

    The folder is ``spark.checkpoint.dir``. Only a local session may go without it; then a
    temporary folder is made once and registered as the session's checkpoint folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlane-"))
        base = context.getCheckpointDir()
    # One folder per application, so that a finished run can be cleared as a whole.
    return f"{base.rstrip('/')}/{context.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def few_files(spark: SparkSession, rows: int, per_file: int) -> int:
    """Files for a table whose size goes with ``rows``: enough for all cores, and no more than ``per_file`` rows to each."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_file))


def materialize(df: DataFrame, label: str = "table", partition_by: list[str] | None = None, reader: SparkSession | None = None, compression: str | None = None, files: int | None = None, bucketed: tuple[int, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, in the session ``reader`` if one is given. A stream hands its batches out in a
    session of its own, which does not plan adaptively.

    Cuts the lineage, survives lost executors, and gives the planner the true size, so that
    later joins are broadcast only when the table really is small. With ``files`` the last tasks take several partitions each, one after
    the other, so that a small table is not written as one file per shuffle partition: without its native library, Hadoop starts two
    processes for every file on a local disk. With ``bucketed`` (buckets, column) a join on the column reads the table as it lies, without a
    shuffle of it.
    """
    spark = df.sparkSession
    path = workspace(spark, label)
    writer = (df.coalesce(files) if files else df).write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    if bucketed:
        # Only a catalog keeps buckets; the entry goes again, the files stay.
        name = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
        writer.format("parquet").bucketBy(*bucketed).sortBy(bucketed[1]).option("path", path).saveAsTable(name)
        table = spark.table(name)
        spark.sql(f"DROP TABLE {name}")
        return table
    writer.parquet(path)
    return (reader or spark).read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Have Spark remove the files of shuffles whose results have been written; it does when the driver's collector meets them."""
    # What the first collection lets go holds more that the second one finds.
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Removes the files of a table that ``materialize`` has written; nothing may read it any more."""
    context = df.sparkSession.sparkContext
    for folder in {path.rsplit("/", 1)[0] for path in df.inputFiles()}:
        at = context._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
