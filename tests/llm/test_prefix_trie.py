"""The conversation trie against plain Python, and its parts."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import prefix_trie
from ledgerlane.llm.queries import QUERIES, rebuilt

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows, joined=True):
    """The nodes of the trie from the contract, by enumerating all prefixes."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(a)] for c, a in own.items()}
    whole = {}
    for c, a in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if joined else 0
        whole[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + a[h:]
    members = defaultdict(list)
    for c, a in whole.items():
        for d in range(len(a) + 1):
            members[tuple(a[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members[p]) - 1) * (len(brute.words(p[-1][1])) if p else 0)
    ends = {p: ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)) for p, m in members.items()}
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], brute.sha(ends[p])) for p, m in members.items())


def got(nodes):
    assert set(nodes.columns) - {"key"} == {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"}
    return Counter((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in nodes.collect())


def chats(seed, n, turns, words):
    random.seed(seed)
    rows = []
    for c in range(n):
        size = random.choice([1, 2, 3, turns, random.randrange(1, turns + 1)])
        rows += [(c, t, random.choice(["user", "assistant", None]), random.choice(words)) for t in range(size)]
    rows += [(c, t, "user", f"common {t}") for c in range(n, n + n // 2) for t in range(4)]  # a very common conversation
    rows += [(2 * n, t, "user", f"common {t}") for t in range(200)]  # a long one below it
    rows += [(2 * n + 1, None, None, None), (2 * n + 1, None, "a", "b  c"), (2 * n + 1, 5, "z", "x"), (2 * n + 1, 5, "z", "a"), (2 * n + 1, 5, "z", "a"), (None, 1, "user", "lost"), (-7, 0, "", ""), (-7, 1, "user", "")]
    return rows


@pytest.mark.parametrize("first,growth", [(4096, 16), (3, 2), (1, 40)])
def test_equals_brute_force(spark, monkeypatch, first, growth):
    """One batch, many batches that hardly grow, and batches in which long branches are new."""
    monkeypatch.setattr(prefix_trie, "FIRST_BATCH", first)
    monkeypatch.setattr(prefix_trie, "GROWTH", growth)
    rows = chats(first, 60, 7, ["a", "b c", "", None])
    df = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit(1) for n in ("end", "way", "first", "key", "n", "symbol")}).repartition(5)
    assert got(prefix_trie.prefix_trie(rebuilt(prefix_trie.conversations(df)))) == expected(rows)


def test_other_column_names_without_ties(spark):
    rows = [(c, t, "user", f"{c % 3 if t else 0} {'w ' * t}") for c in range(30) for t in range(c % 5 + 1)]
    df = spark.createDataFrame(rows, "i long, n long, who string, said string")
    assert got(prefix_trie.prefix_trie(prefix_trie.conversations(df, "i", "n", "who", "said"))) == expected(rows, joined=False)


def test_turnless_and_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(rebuilt(prefix_trie.conversations(empty))).count() == 0
    assert QUERIES["op11_prefix_trie"](spark, SF).columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # Conversation 1 has no turn of its own beyond those that are taken from a conversation that is absent.
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 5, 6)]
    found = got(prefix_trie.prefix_trie(rebuilt(prefix_trie.conversations(spark.createDataFrame(rows, SCHEMA)))))
    assert found == expected(rows) and any(d == 0 and e != hashlib.sha256(b"").hexdigest() for _, d, *_, e in found)


def test_long_texts_and_long_conversations(spark):
    rows = [(0, t, "user", f"{t} " * 3) for t in range(3000)] + [(1, t, "user", f"{t} " * 3) for t in range(2999)] + [(40, 0, "user", "word " * 200_000), (41, 0, "user", "word " * 200_000 + "end")]
    found = got(prefix_trie.prefix_trie(prefix_trie.conversations(spark.createDataFrame(rows, SCHEMA))))
    nothing = brute.sha("")
    assert sum(found.values()) == 1 + 3000 + 2 and found[0, 3000, 0, 1, 0, 1, 0, brute.sha("0")] == 1 and found[0, 2999, 0, 2, 1, 1, 3, brute.sha("1")] == 1
    assert found[0, 0, None, 4, 3, 3, 3 * 2999, nothing] == 1 and found[40, 1, 0, 1, 0, 1, 0, brute.sha("40")] == found[41, 1, 0, 1, 0, 1, 0, brute.sha("41")] == 1


def test_corpus(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_prefix_trie"](spark, SF)) == expected(rows)


def test_two_fattest_and_common():
    for a in range(40):
        for b in range(a + 1, 41):
            assert prefix_trie.two_fattest(a, b) == max(range(a + 1, b + 1), key=lambda x: x & -x)
    chain = [hashlib.md5(str(k).encode()).digest() + bytes(8) for k in range(9)]
    for k in range(9):
        assert prefix_trie.common(b"".join(chain), b"".join(chain[:k]) + b"x" * 24) == k
