"""Trie of conversation prefixes, as a z-fast trie in tables.

A conversation is a sequence of turns. The trie is kept compacted: a row per node that ends a conversation or
branches, with the edge that leads to it. Every depth of a sequence has a chained 128-bit hash of all turns up to
there, so a prefix is known by its hash. A node on the edge from depth p to depth e is filed under its *handle*, the hash at
the two-fattest number of (p, e], the one with the most trailing zero bits.

1. *Locate.* A conversation's way down is found by fat binary search: look up the hash at the two-fattest depth of
   what is left of (a, b]; when a node is filed there and its whole edge lies on the way, go on below it, when not,
   above. Each step is one join of all conversations with the handles; there are as many steps as the longest
   conversation has binary digits. A last join by the first turn of an edge gives the exit node, and comparing
   its edge gives the depth at which the conversation leaves it.
2. *Insert in batches.* Edges are cut where conversations leave them; conversations that leave at one place by the same
   turn make a new branch. Batches are in random (hash) order and grow by ``GROWTH``: a new branch
   has many conversations of a batch only if none of all batches before went there, so with high
   probability it has a few hundred at most, however popular a first turn is. Within a branch they are sorted and
   turned into nodes in one pass with a stack.
3. *Sums of subtrees* by pointer doubling over the compacted nodes, with sums made before the shuffle.
4. *Expand edges.* Every depth on an edge is a node of the trie; it differs from its edge's lower end in what lies above it only.

Equal conversations are one sequence with a count. Per turn 24 bytes go on (hash, running number of words); texts are hashed
where they are read. A conversation is one row, and its ids' digest is made from stretches of the sorted ids, in order.

Turns are ordered by turn (NULL first), then role, then text. NULL roles and texts are empty. Rows without a conversation id
are left out. Repeated rows are turns of their own. An empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialize

HASH, RECORD = 16, 24
FIRST_BATCH = 4096
GROWTH = 16
ID_STRETCH = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): per conversation the array of (symbol, words) in order; the symbol is a digest of role and text."""
    own = {"conv_id": F.col(f"`{conv_id}`").cast("bigint"), "turn": F.col(f"`{turn}`").cast("bigint"), "role": F.coalesce(F.col(f"`{role}`"), F.lit("")), "text": F.coalesce(F.col(f"`{text}`"), F.lit(""))}
    whole = rows.select(*[c.alias(n) for n, c in own.items()]).filter("conv_id IS NOT NULL")
    symbol = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    light = whole.select("conv_id", "turn", symbol.alias("symbol"), F.regexp_count("text", F.lit(_WORD)).cast("bigint").alias("words"), F.lit(0).alias("rank"))
    # Only rows that share a turn number are ordered by their texts.
    ties = materialize(light.groupBy("conv_id", "turn").count().filter("count > 1").select("conv_id", F.col("turn").alias("tied")), "tied-turns")
    if not ties.isEmpty():
        tied = whole.join(ties, (whole.conv_id == ties.conv_id) & whole.turn.eqNullSafe(ties.tied)).select(whole.conv_id, "turn", symbol.alias("symbol"), "role", "text")
        ranks = tied.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("symbol").alias("s"), F.dense_rank().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text")).alias("r")).distinct()
        light = light.join(ranks, (light.conv_id == ranks.c) & light.turn.eqNullSafe(ranks.t) & (light.symbol == ranks.s), "left").withColumn("rank", F.coalesce("r", "rank"))
    ordered = light.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "rank", "symbol", "words"))).alias("a"))
    return ordered.select("conv_id", F.transform("a", lambda t: F.struct(t["symbol"].alias("symbol"), t["words"].alias("words"))).alias("turns"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, end, way): the chained hash at the end, and for every depth a record of hash and running number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, ways = [], []
            for symbols, words in zip(batch.column(1), batch.column(2).to_pylist()):
                at, total, way = b"", 0, bytearray()
                for symbol, n in zip(symbols.as_py(), words):
                    at = hashlib.blake2b(at + symbol, digest_size=HASH).digest()
                    total += n
                    way += at + total.to_bytes(RECORD - HASH, "big")
                ends.append(at)
                ways.append(bytes(way))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends, pa.binary()), pa.array(ways, pa.binary())], names=["conv_id", "end", "way"])

    return turns.select("conv_id", "turns.symbol", "turns.words").mapInArrow(run, "conv_id bigint, end binary, way binary")


def two_fattest(a: int, b: int) -> int:
    """The number in (a, b] with the most trailing zero bits."""
    return b & (-1 << ((a ^ b).bit_length() - 1))


_NODE = "key binary, parent binary, first binary, handle binary, top int, depth int, base bigint, edge binary"
_NAMES = [c.split()[0] for c in _NODE.split(", ")]
_TYPES = [pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]


def _hash_at(way: bytes, depth: int) -> bytes:
    return way[(depth - 1) * RECORD : (depth - 1) * RECORD + HASH] if depth else b""


def _node(edge: bytes, top: int, parent: bytes, base: int) -> tuple:
    """The row of the node at the end of an edge that begins below depth ``top``."""
    depth = top + len(edge) // RECORD
    return _hash_at(edge, depth - top), parent, edge[:HASH], _hash_at(edge, two_fattest(top, depth) - top), top, depth, base, edge


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_TYPES)], names=_NAMES)


def _words_at(way: bytes, depth: int) -> int:
    return int.from_bytes(way[depth * RECORD - (RECORD - HASH) : depth * RECORD], "big") if depth else 0


def cut_edges(nodes: DataFrame) -> DataFrame:
    """Nodes whose edges are cut at the sorted depths ``cuts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for parent, top, depth, base, edge, cuts in zip(*(batch.column(k).to_pylist() for k in range(6))):
                at = top
                for to in [*cuts, depth]:
                    out.append(_node(edge[(at - top) * RECORD : (to - top) * RECORD], at, parent, base))
                    parent, base, at = out[-1][0], _words_at(edge, to - top), to
            yield _node_batch(out)

    return nodes.select("parent", "top", "depth", "base", "edge", "cuts").mapInArrow(run, _NODE)


def new_branches(leaving: DataFrame) -> DataFrame:
    """Nodes for the sequences (branch, at, way) that leave the trie at depth ``at`` by the turn with hash ``branch``."""
    dealt = leaving.select("branch", "at", "way").repartition("branch").sortWithinPartitions("branch", "way")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, depths, out = None, b"", [0], []

        def close(depth: int, top: int) -> None:
            out.append(_node(last[top * RECORD : depth * RECORD], top, _hash_at(last, top), _words_at(last, top)))

        for batch in batches:
            for branch, at, way in zip(*(batch.column(k).to_pylist() for k in range(3))):
                shared = common(last, way) if branch == group else 0
                while len(depths) > 1 and depths[-1] > shared:
                    depth = depths.pop()
                    if depths[-1] < shared:
                        depths.append(shared)
                    close(depth, depths[-1])
                if branch != group:
                    group, depths = branch, [at]
                depths.append(len(way) // RECORD)
                last = way
            yield _node_batch(out)
            out.clear()
        while len(depths) > 1:
            depth = depths.pop()
            close(depth, depths[-1])
        yield _node_batch(out)

    return dealt.mapInArrow(run, _NODE)


def common(a: bytes, b: bytes) -> int:
    """Number of records that two ways have in common; hashes are chained, so it is found by halving."""
    low, high = 0, min(len(a), len(b)) // RECORD
    while low < high:
        mid = (low + high + 1) // 2
        if a[(mid - 1) * RECORD : mid * RECORD] == b[(mid - 1) * RECORD : mid * RECORD]:
            low = mid
        else:
            high = mid - 1
    return low


def _at(way: str, depth: str) -> str:
    return f"substring({way}, cast({depth} AS int) * {RECORD} - {RECORD - 1}, {HASH})"


def locate(sought: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """(end, way, at, first): where each sequence leaves the trie, and the edge (by its first turn) in which it does, if within one."""
    handles = nodes.select(F.col("handle").alias("probe"), F.col("key").alias("n_key"), F.col("top").alias("n_top"), F.col("depth").alias("n_depth"))
    state = sought.select("end", "way", (F.octet_length("way") / RECORD).cast("int").alias("size"), F.lit(0).alias("a"), (F.octet_length("way") / RECORD).cast("int").alias("b"))
    for _ in range(longest.bit_length()):
        # Sequences that have arrived are looked up under their own end, so that they stay spread; what is found there is not used.
        state = state.withColumn("zeros", F.expr("CASE WHEN a < b THEN length(bin(a ^ b)) - 1 ELSE 0 END")).withColumn("f", F.expr("shiftleft(shiftright(b, zeros), zeros)"))
        state = state.withColumn("probe", F.expr(f"CASE WHEN a < b THEN {_at('way', 'f')} ELSE end END")).join(handles, "probe", "left")
        state = state.withColumn("on_way", F.expr(f"n_depth <= size AND {_at('way', 'n_depth')} = n_key"))
        a = F.when(F.expr("a >= b OR n_key IS NULL"), F.col("a")).when(F.col("on_way"), F.col("n_depth")).otherwise(F.col("n_top"))
        b = F.when(F.expr("a >= b"), F.col("b")).when(F.col("n_key").isNull(), F.col("f") - 1).when(F.col("on_way"), F.col("b")).otherwise(F.col("n_top"))
        state = state.select("end", "way", "size", a.alias("a"), b.alias("b"))
    edges = nodes.select("first", "edge")
    below = state.withColumn("first", F.expr(f"CASE WHEN a < size THEN {_at('way', 'a + 1')} ELSE end END")).join(edges, "first", "left").select("end", "way", "a", "size", "first", "edge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, exits = [], []
            for way, a, size, first, edge in zip(*(batch.column(k).to_pylist() for k in range(1, 6))):
                inside = a < size and edge is not None
                at.append(a + common(way[a * RECORD :], edge) if inside else a)
                exits.append(first if inside and at[-1] - a < len(edge) // RECORD else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(at, pa.int32()), pa.array(exits, pa.binary())], names=["end", "way", "at", "first"])

    return below.mapInArrow(run, "end binary, way binary, at int, first binary")


def insert(nodes: DataFrame | None, batch: DataFrame, longest: int) -> DataFrame:
    """The trie with a batch of sequences (end, way) in it."""
    if nodes is None:
        exits = batch.select("end", "way", F.lit(0).alias("at"))
    else:
        exits = materialize(locate(batch, nodes, longest), "exits")
    leaving = exits.filter(F.octet_length("way") > F.col("at") * RECORD)
    fresh = new_branches(leaving.select(F.expr(_at("way", "at + 1")).alias("branch"), "at", "way"))
    if nodes is None:
        return materialize(fresh, "trie")
    # At most as many cuts as the edge has turns.
    cuts = materialize(exits.filter("first IS NOT NULL").groupBy("first").agg(F.sort_array(F.collect_set("at")).alias("cuts")), "cuts")
    return materialize(nodes.join(cuts, "first", "left_anti").select(_NAMES).union(cut_edges(nodes.join(cuts, "first"))).union(fresh), "trie")


def build(distinct: DataFrame) -> DataFrame | None:
    """The compacted trie of distinct sequences (end, way), without its root."""
    n, longest = distinct.agg(F.count("*"), F.max(F.octet_length("way"))).first()
    place, nodes, low, high = F.xxhash64("end").bitwiseAND((1 << 40) - 1), None, 0, FIRST_BATCH
    while n:
        upto = min(1 << 40, (high << 40) // n)
        nodes = insert(nodes, distinct.filter((place >= low) & (place < upto)), longest // RECORD)
        if upto == 1 << 40:
            break
        low, high = upto, high * GROWTH
    return nodes


def id_digests(members: DataFrame) -> DataFrame:
    """(end, digest): SHA-256 of the ascending ids of every sequence, joined by commas.

    Ids are sorted over all tasks and packed into stretches of text; only these meet, in order, where the digest is made.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, ids, least = None, [], 0
        rows: list[tuple] = []

        def flush() -> None:
            if ids:
                rows.append((end, least, ",".join(map(str, ids))))
                ids.clear()

        for batch in batches:
            for key, i in zip(*(batch.column(k).to_pylist() for k in range(2))):
                if key != end or len(ids) >= ID_STRETCH:
                    flush()
                    end, least = key, i
                ids.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string()))], names=["end", "least", "ids"])
            rows.clear()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.binary(), pa.int64(), pa.string()))], names=["end", "least", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, sha = None, None
        for batch in batches:
            rows = []
            for key, ids in zip(*(batch.column(k).to_pylist() for k in (0, 2))):
                if key != end:
                    if sha:
                        rows.append((end, sha.hexdigest()))
                    end, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["end", "digest"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([sha.hexdigest()], pa.string())], names=["end", "digest"])

    stretches = members.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id").mapInArrow(pack, "end binary, least bigint, ids string")
    return stretches.repartition("end").sortWithinPartitions("end", "least").mapInArrow(digest, "end binary, digest string")


_SUMS = ["n", "leaves", "words", "edge_words"]


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """(key, least, n, leaves, words, edge_words) added up over subtrees, by pointers that double their reach each round."""
    state = materialize(nodes.select("key", F.col("parent").alias("up"), "least", *_SUMS), "subtrees")
    while not state.filter("up IS NOT NULL").isEmpty():
        moving = state.filter("up IS NOT NULL")
        added = moving.groupBy("up").agg(F.min("least").alias("u_least"), *[F.sum(c).alias(f"u_{c}") for c in _SUMS]).withColumnRenamed("up", "key")
        ups = moving.select("key", "up").join(state.select(F.col("key").alias("up"), F.col("up").alias("further")), "up").select("key", "further")
        state = state.join(added, "key", "left").join(ups, "key", "left")
        state = materialize(state.select("key", F.col("further").alias("up"), F.least("least", "u_least").alias("least"), *[(F.col(c) + F.coalesce(f"u_{c}", F.lit(0))).alias(c) for c in _SUMS]), "subtrees")
    return state.drop("up")


def prefix_trie(turns: DataFrame) -> DataFrame:
    """All nodes of the trie of conversations (conv_id, turns), see ``conversations``: key (hash of the prefix), conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members = materialize(sequences(turns), "sequences")
    ends = members.groupBy("end").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    ends = materialize(ends.join(members.select(F.col("conv_id").alias("least"), "way"), "least"), "ends")
    empty = members.sparkSession.createDataFrame([], _NODE)
    root = F.lit(b"")
    compacted = build(ends.filter(F.octet_length("way") > 0).select("end", "way"))
    nodes = compacted if compacted is not None else empty
    if ends.isEmpty():
        return _expanded(empty.select("*", *[F.lit(None).cast("bigint").alias(c) for c in ("least", "n", "leaves", "words", "edge_words", "children", "parent_least")], F.lit("").alias("digest")))
    top = members.sparkSession.range(1).select(root.alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(None).cast("binary").alias("first"), F.lit(None).cast("binary").alias("handle"),
                                               F.lit(-1).alias("top"), F.lit(0).alias("depth"), F.lit(0).cast("bigint").alias("base"), F.lit(b"\0" * RECORD).alias("edge"))
    nodes = nodes.unionByName(top)
    children = nodes.filter("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("children")).withColumnRenamed("parent", "key")
    digests = id_digests(members).withColumnRenamed("end", "key")
    last_words = F.conv(F.hex(F.expr(f"substring(way, -{RECORD - HASH}, {RECORD - HASH})")), 16, 10).cast("bigint")
    own = ends.select(F.col("end").alias("key"), "n", "least", (F.col("n") * F.when(F.octet_length("way") > 0, last_words).otherwise(0)).alias("words"))
    nodes = nodes.join(children, "key", "left").join(own, "key", "left").join(digests, "key", "left")
    reached = F.conv(F.hex(F.expr(f"substring(edge, -{RECORD - HASH}, {RECORD - HASH})")), 16, 10).cast("bigint")
    nodes = nodes.select(*_NAMES, "digest", "least", F.coalesce("children", F.lit(0)).cast("bigint").alias("children"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                         F.coalesce("words", F.lit(0)).cast("bigint").alias("words"), F.when(F.col("children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"), (reached - F.col("base")).alias("edge_words"))
    nodes = materialize(nodes, "counted-nodes")
    sums = materialize(subtree_sums(nodes), "subtree-sums")
    whole = nodes.drop("least", *_SUMS).join(sums, "key")
    return _expanded(whole.join(sums.select(F.col("key").alias("parent"), F.col("least").alias("parent_least")), "parent", "left"))


def _expanded(nodes: DataFrame) -> DataFrame:
    """A row per depth of every edge."""
    nothing = hashlib.sha256(b"").hexdigest()
    fields = "key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
    names = [c.split()[0] for c in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for edge, top, depth, base, least, parent_least, n, children, leaves, words, edge_words, digest in zip(*(batch.column(k).to_pylist() for k in range(12))):
                before = base
                for d in range(top + 1, depth + 1):
                    record = edge[(d - top - 1) * RECORD : (d - top) * RECORD]
                    last = d == depth
                    # All words below depth d - 1 of all members, less those words once per node.
                    saved = words - n * before - (edge_words - (before - base))
                    out.append((record[:HASH] if d else b"", least, d, parent_least if d == top + 1 else least, n, children if last else 1, leaves, saved, (digest or nothing) if last else nothing))
                    before = int.from_bytes(record[HASH:], "big")
            kinds = [pa.binary(), *[pa.int64()] * 7, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=names)

    order = ["edge", "top", "depth", "base", "least", "parent_least", "n", "children", "leaves", "words", "edge_words", "digest"]
    return nodes.select(order).mapInArrow(run, fields)
