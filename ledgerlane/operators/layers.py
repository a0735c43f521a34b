"""A keyed table on plain parquet whose updates cost what they change.

The table is a *base* and numbered *layers* above it. A layer has the rows that one batch wrote; of the rows of a key the one in the
highest layer holds. Writing a batch writes a layer and nothing else. Layers of similar size are merged, and
all go into a new base once they hold half as many bytes as it, so every row is rewritten a number of times that grows
with the logarithm of the table, and the folder stays in proportion to its content.

A folder counts when the mark that its writing job sets last is there; half-written ones are not seen. Batch n reads what
is below n only, so a batch that is repeated writes the same layer again. Merging happens for layers below the running batch,
which nothing repeats any more. One writer at a time.

The base is cut into buckets by a hash of ``bucket_by``; their number follows the size at each new base. An index
from the values of ``index_by`` to buckets lies beside it, for reading by another column.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import discard, let_go, materialize
from ..sources import folders

BUCKET_BYTES = 128 << 20
# Layers are left alone while there are few of them and they are small.
MERGE_LAYERS = 8
MERGE_BYTES = 32 << 20
# More touched buckets than this are not named in a filter.
NAMED_BUCKETS = 10_000
MERGE_FROM = 4


@dataclass(frozen=True)
class _Layer:
    name: str
    first: int
    last: int
    buckets: int = 0


@dataclass
class LayeredTable:
    """Rows by ``keys``; ``schema`` has all columns."""

    path: str
    schema: StructType
    keys: list[str]
    bucket_by: str | None = None
    index_by: str | None = None
    bucket_bytes: int = field(default=BUCKET_BYTES)

    def _stored(self, spark: SparkSession, below: int | None) -> tuple[_Layer | None, list[_Layer]]:
        """The base and the layers that count for a reader below batch ``below``."""
        bases, layers = [], []
        for name in folders.names(spark, self.path):
            kind, *numbers = name.split("-")
            if kind not in ("base", "layer") or not folders.complete(spark, f"{self.path}/{name}"):
                continue
            first, last, buckets = map(int, numbers)
            if below is None or last < below:
                (bases if kind == "base" else layers).append(_Layer(name, first, last, buckets))
        base = max(bases, key=lambda b: b.last, default=None)
        layers = [a for a in layers if base is None or a.last > base.last]
        # A merged layer stands for those it was made of.
        layers = [a for a in layers if not any(b != a and b.first <= a.first and a.last <= b.last for b in layers)]
        return base, sorted(layers, key=lambda a: a.last)

    def _read(self, spark: SparkSession, layer: _Layer, bucketed: bool = False) -> DataFrame:
        schema = StructType([*self.schema.fields]).add("bucket", "integer") if bucketed and layer.buckets else self.schema
        return spark.read.schema(schema).parquet(f"{self.path}/{layer.name}")

    def _bucket(self, layer: _Layer) -> Column:
        return F.pmod(F.xxhash64(F.col(self.bucket_by)), F.lit(layer.buckets)).cast("int")

    def _from_base(self, spark: SparkSession, base: _Layer, among: DataFrame | None) -> DataFrame:
        rows = self._read(spark, base, bucketed=True)
        if among is not None and base.buckets > 1:
            where = None
            if self.bucket_by in among.columns:
                where = among.select(self._bucket(base).alias("bucket"))
            elif self.index_by in among.columns:
                where = spark.read.parquet(f"{self.path}/index-{base.last}").join(among.select(self.index_by).distinct(), self.index_by, "left_semi").select("bucket")
            if where is not None:
                touched = [r[0] for r in where.distinct().limit(NAMED_BUCKETS + 1).collect()]
                if len(touched) <= NAMED_BUCKETS:
                    rows = rows.filter(F.col("bucket").isin(touched))
        return rows.select(*self.schema.fieldNames())

    def empty(self, spark: SparkSession, below: int | None = None) -> bool:
        base, layers = self._stored(spark, below)
        return base is None and not layers

    def rows(self, spark: SparkSession, below: int | None = None, among: DataFrame | None = None) -> DataFrame:
        """One row per key as of all batches below ``below``; with ``among`` only rows that agree with one of its rows in its columns.

        ``among`` is small against the table; with the bucket or index column in it, only buckets that can have such rows are read.
        """
        base, layers = self._stored(spark, below)
        names = self.schema.fieldNames()
        if base is None and not layers:
            return spark.createDataFrame([], self.schema)
        if among is not None:
            # Few rows: those of base and layers together, the highest of each key.
            found = [] if base is None else [self._from_base(spark, base, among).withColumn("__n", F.lit(base.last))]
            rows = reduce(DataFrame.unionByName, [*found, *[self._read(spark, a).withColumn("__n", F.lit(a.last)) for a in layers]])
            rows = rows.join(among.distinct(), among.columns, "left_semi")
            if set(among.columns) <= set(self.keys):
                return rows.select(*names) if len(layers) + len(found) == 1 else self._highest(rows)
            # A row that agrees may be hidden by one that does not, in a layer.
            return self._uncovered(spark, self._highest(rows.withColumn("__low", F.col("__n")), "__low"), layers)
        newest = self._highest(reduce(DataFrame.unionByName, [self._read(spark, a).withColumn("__n", F.lit(a.last)) for a in layers])) if len(layers) > 1 else self._read(spark, layers[0]) if layers else None
        if base is None:
            return newest.select(*names)
        if newest is None:
            return self._from_base(spark, base, None)
        return self._uncovered(spark, self._from_base(spark, base, None).withColumn("__low", F.lit(base.last)), layers).unionByName(newest.select(*names))

    def _highest(self, rows: DataFrame, *further: str) -> DataFrame:
        """Per key the row with the greatest ``__n``."""
        best = F.max_by(F.struct(*self.schema.fieldNames(), *further), "__n").alias("r")
        return rows.groupBy(*[F.col(k).alias(f"__{k}") for k in self.keys]).agg(best).select("r.*")

    def _uncovered(self, spark: SparkSession, rows: DataFrame, layers: list[_Layer]) -> DataFrame:
        """``rows`` whose keys are in no layer above their own, ``__low``."""
        if layers:
            above = reduce(DataFrame.unionByName, [self._read(spark, a).select(*[F.col(k).alias(f"__{k}") for k in self.keys], F.lit(a.last).alias("__above")) for a in layers])
            rows = rows.join(above, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys]) & (F.col("__above") > F.col("__low")), "left_anti")
        return rows.select(*self.schema.fieldNames())

    def write(self, rows: DataFrame, number: int) -> DataFrame:
        """Write the rows of batch ``number``, full rows, one per key, and read them back. Writing it again replaces it.

        Further columns of ``rows`` are kept in the layer, so that who wrote it need not write them elsewhere; the table does not see them.
        """
        own = {f.name: f.dataType for f in self.schema.fields}
        rows = rows.select(*[F.col(n).cast(t).alias(n) for n, t in own.items()], *[c for c in rows.columns if c not in own])
        path = f"{self.path}/layer-{number}-{number}-0"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def merge(self, spark: SparkSession, below: int) -> None:
        """Put layers below batch ``below`` together where that is due, and remove what they replace."""
        base, layers = self._stored(spark, below)
        if layers:
            sizes = [folders.size(spark, f"{self.path}/{a.name}") for a in layers]
            held = folders.size(spark, f"{self.path}/{base.name}") if base else 0
            if len(layers) < MERGE_LAYERS and sum(sizes) < MERGE_BYTES:
                pass
            elif 2 * sum(sizes) >= held:
                self._new_base(spark, below, layers[-1].last, held + sum(sizes))
            else:
                # From the newest on: layers no more than twice as large as all above them.
                taken, total = [], 0
                for a, n in zip(reversed(layers), reversed(sizes)):
                    if taken and n > 2 * total:
                        break
                    taken, total = [a, *taken], total + n
                if len(taken) >= MERGE_FROM:
                    self._merged(spark, taken).write.mode("overwrite").parquet(f"{self.path}/layer-{taken[0].first}-{taken[-1].last}-0")
        self._clear(spark, below)

    def _merged(self, spark: SparkSession, layers: list[_Layer]) -> DataFrame:
        return self._highest(reduce(DataFrame.unionByName, [self._read(spark, a).withColumn("__n", F.lit(a.last)) for a in layers]))

    def _new_base(self, spark: SparkSession, below: int, last: int, size: int) -> None:
        rows = self.rows(spark, below)
        buckets = 0
        if self.bucket_by:
            buckets = 1 << max(0, (size // self.bucket_bytes)).bit_length()
        layer = _Layer(f"base-0-{last}-{buckets}", 0, last, buckets)
        if not buckets:
            rows.write.mode("overwrite").parquet(f"{self.path}/{layer.name}")
            return
        rows = rows.withColumn("bucket", self._bucket(layer))
        staged = None
        if self.index_by:
            rows = staged = materialize(rows, "base")
            let_go(spark)
            rows.select(self.index_by, "bucket").distinct().write.mode("overwrite").parquet(f"{self.path}/index-{last}")
        rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{layer.name}")
        if staged is not None:
            discard(staged)

    def _clear(self, spark: SparkSession, below: int) -> None:
        """Remove finished folders below batch ``below`` that no longer count, and halves of them."""
        base, layers = self._stored(spark, below)
        counted = {a.name for a in layers} | ({base.name, f"index-{base.last}"} if base else set())
        for name in folders.names(spark, self.path):
            last = name.split("-")
            if name not in counted and len(last) >= 2 and int(last[1] if last[0] == "index" else last[2]) < below:
                folders.remove(spark, f"{self.path}/{name}")
