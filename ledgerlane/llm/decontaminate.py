"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact check.

Words are lower-cased runs of letters and digits; a shingle is five words (all words of a shorter text).
A window has as many shingles as the item it is held against, fewer at the end of a document.
Similarity is the weighted Jaccard coefficient of the two bags of shingles, the weight of a shingle
being its number of occurrences.

1. A window of the wanted similarity has a least number of its places in common with the item. So shingles
   are joined with those of the items, and only windows that begin at a common place and hold
   enough common places go on; shifting a window to its next common place never loses similarity.
2. Their SimHash fingerprints (64 bits) are cut into ``RADIUS`` + 1 blocks. Two fingerprints that differ in at most
   ``RADIUS`` bits agree in a block, so joining on (item, block, value) misses none of them.
3. Candidates within the radius are verified by the exact similarity.
4. One shingle with a large weight can move a fingerprint by more than any radius while the similarity stays high. So windows of step 1 that the
   blocks do not bring together with their item are held against it exactly as well; nothing is lost to the radius.

Everything is DataFrame functions. The items' shingles are broadcast up to ``BROADCAST_ROWS`` rows and
joined by a shuffle beyond. NULL and empty texts and items match nothing; rows that repeat an id and a text
count once; a NULL id, of a document or an item, is reported as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import few_files, materialize
from .columns import as_rows, let

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 23
BITS = 64
BROADCAST_ROWS = 500_000
#: Documents or items whose findings go to one file, and windows that do.
FILE_ROWS, FILE_WINDOWS = 1 << 14, 1 << 12
# Bits of each block: as even as 24 blocks of 64 bits can be.
BLOCK_BITS = [3] * 16 + [2] * 8


def words(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]+", "")
    return F.array_remove(F.split(plain, r"[\x20\x09-\x0D]+"), "")


def _chained(left: Column, right: Column, step: int) -> Column:
    n = F.size(left) - step
    return F.zip_with(F.slice(left, 1, n), F.slice(right, step + 1, n), lambda a, b: F.xxhash64(a, b))


def shingles(text: Column) -> Column:
    """Hashes of the runs of five words, in order; one for a shorter text, none for no words."""
    marks = F.transform(words(text), lambda w: F.xxhash64(w))

    def of(m: Column) -> Column:
        fours = let(_chained(m, m, 1), lambda two: _chained(two, two, 2))
        fives = let(fours, lambda four: F.zip_with(four, F.slice(m, SHINGLE, F.size(four)), lambda a, b: F.xxhash64(a, b)))
        fives = F.slice(fives, F.lit(1), F.size(m) - (SHINGLE - 1))
        return F.when(F.size(m) >= SHINGLE, fives).when(F.size(m) > 0, F.array(F.xxhash64(m))).otherwise(F.array().cast("array<bigint>"))

    return let(marks, of)


def fingerprint(bag: Column) -> Column:
    """SimHash of an array of hashes: bit b is set where more of them have it than not."""

    def bit(b: Column) -> Column:
        votes = F.aggregate(bag, F.lit(0), lambda total, h: total + F.when(F.bit_get(h, b) == 1, 1).otherwise(-1))
        return F.when(votes > 0, F.lit("1")).otherwise(F.lit("0"))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit), "")


def _blocks(bits: Column) -> Column:
    """(block, value) of a fingerprint."""
    at, out = 1, []
    for k, width in enumerate(BLOCK_BITS):
        out.append(F.concat(F.lit(f"{k}:"), F.substring(bits, at, width)))
        at += width
    return F.array(*out)


def _distance(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x != y), lambda d: d))


def _counts(bag: Column) -> Column:
    return let(bag, lambda b: F.transform(F.array_distinct(b), lambda h: F.struct(h.alias("h"), F.size(F.filter(b, lambda x: x == h)).alias("c"))))


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard coefficient of two bags (arrays)."""

    def common(counted: Column, other: Column) -> Column:
        return F.aggregate(counted, F.lit(0), lambda total, x: total + F.least(x["c"], F.size(F.filter(other, lambda y: y == x["h"]))))

    # Without repeats, which is usual, the bags are sets and meet in one pass.
    alone = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    shared = let(b, lambda other: F.when(alone, F.size(F.array_intersect(a, other))).otherwise(common(_counts(a), other)))
    return let(shared, lambda s: s / (F.size(a) + F.size(b) - s))


def _identity(doc_id: str, text: str) -> list[Column]:
    return [F.col(f"`{doc_id}`").cast("bigint").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("mark")]


def contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 least: float = SIMILARITY) -> DataFrame:
    """(id, mark, item_id, similarity, start, distance): the best window of every document and item that match.

    ``mark`` tells texts of the same id apart; ``start`` is the window's first word, from 0.
    """
    # All tables written here are small beside the texts, whatever the number of shuffle partitions.
    spark, many = docs.sparkSession, items.count()
    held = items.select(F.col(f"`{item_id}`").alias("item_id"), shingles(F.col(f"`{item_text}`")).alias("bag"))
    held = held.filter(F.size("bag") > 0).dropDuplicates(["item_id", "bag"])
    held = materialize(held.select("item_id", F.xxhash64("item_id", F.col("item_id").isNull(), "bag").alias("version"), "bag", F.size("bag").alias("m"), let(F.col("bag"), fingerprint).alias("print")), "benchmark-items", files=few_files(spark, many, FILE_ROWS))
    wanted = materialize(held.select("item_id", "version", "m", F.explode(F.array_distinct("bag")).alias("h")), "benchmark-shingles", files=few_files(spark, many, FILE_ROWS))
    small = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted

    places = docs.select(*_identity(doc_id, text), shingles(F.col(f"`{text}`")).alias("bag"))
    places = places.select("id", "mark", F.size("bag").alias("n"), F.posexplode("bag").alias("p", "h"))
    hits = places.join(small, "h").groupBy("id", "mark", "item_id", "version").agg(F.sort_array(F.collect_set("p")).alias("at"), F.first("n").alias("n"), F.first("m").alias("m"))

    # A start is kept when enough common places follow within the window.
    def need(s: Column) -> Column:
        return F.ceil(least / (1 + least) * (F.col("m") + F.least(F.col("m"), F.col("n") - s)) - 1e-9).cast("int")

    def promising(s: Column, k: Column) -> Column:
        return F.coalesce(F.get(F.col("at"), k + F.greatest(need(s), F.lit(1)) - 1) < s + F.col("m"), F.lit(False))

    starts = hits.select("id", "mark", "item_id", "version", "m", F.explode(F.filter("at", promising)).alias("start"))
    starts = materialize(starts, "windows", files=few_files(spark, docs.count(), FILE_ROWS))

    named = starts.select("id", "mark").distinct()
    same = [F.col("d.id").eqNullSafe(F.col("w.id")), F.col("d.mark") == F.col("w.mark")]
    bodies = docs.select(*_identity(doc_id, text), F.col(f"`{text}`").alias("t")).alias("d").join(named.alias("w"), same, "left_semi")
    bags = bodies.dropDuplicates(["id", "mark"]).select("id", "mark", shingles(F.col("t")).alias("all"))
    windows = starts.alias("w").join(bags.alias("d"), same).select("w.id", "w.mark", "item_id", "version", "start", F.slice("all", F.col("start") + 1, F.col("m")).alias("window"))
    windows = materialize(windows.select("*", let(F.col("window"), fingerprint).alias("print")), "prints", files=few_files(spark, starts.count(), FILE_WINDOWS))

    by_block = held.select("version", F.col("print").alias("own"), F.explode(_blocks(F.col("print"))).alias("block"))
    place = ["id", "mark", "version", "start"]
    met = windows.select(*place, "print", F.explode(_blocks(F.col("print"))).alias("block")).join(by_block, ["version", "block"]).dropDuplicates(place)
    met = met.filter(_distance(F.col("print"), F.col("own")) <= RADIUS)
    met = met.select(*[F.col(c).alias(f"m_{c}") for c in place], F.lit(True).alias("met"))
    both = windows.join(met, [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in place], "left").join(held.select("version", "bag", F.col("print").alias("own")), "version")
    # Candidates of the blocks, and the exact way for the rest.
    checked = both.withColumn("similarity", similarity(F.col("window"), F.col("bag"))).filter(F.col("similarity") >= least)
    near = checked.withColumn("distance", _distance(F.col("print"), F.col("own"))).withColumn("by_blocks", F.coalesce("met", F.lit(False)))
    best = near.groupBy("id", "mark", "item_id").agg(F.max(F.struct("similarity", -F.col("start"), F.col("distance").alias("d"))).alias("x"))
    return best.select("id", "mark", "item_id", F.round("x.similarity", 6).alias("similarity"), (-F.col("x.col2")).cast("long").alias("start"), F.col("x.d").cast("long").alias("distance"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows in which an item was found, with all their columns."""
    found = materialize(contaminated(docs, items, doc_id, text).select("id", "mark").distinct(), "contaminated", files=few_files(docs.sparkSession, docs.count(), FILE_ROWS))
    rows = docs.select(as_rows(docs), *_identity(doc_id, text)).alias("d")
    clean = rows.join(found.alias("w"), [F.col("d.id").eqNullSafe(F.col("w.id")), F.col("d.mark") == F.col("w.mark")], "left_anti")
    return clean.select("__row.*")
