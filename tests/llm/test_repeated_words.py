"""Long repeated word sequences, against plain Python."""

import random
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from ledgerlane.llm import substring_dedup
from ledgerlane.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def got(df, **parameters):
    rows = substring_dedup.remove_repeats(df, **parameters).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha"))
    return Counter((r.doc_id, r.n_words, r.n_removed, r.sha) for r in rows.collect())


def wanted(rows, length):
    return Counter((i, *found) for (i, _), found in zip(rows, brute.without_repeated_words([t for _, t in rows], length)))


def passages(seed, alphabet, length):
    """Texts that share passages at all sorts of places, with branches, loops, one common line and one common passage."""
    random.seed(seed)
    words = [f"w{k}" for k in range(alphabet)]
    some = lambda n: [random.choice(words) for _ in range(n)]
    shared = [some(random.choice([length - 1, length, length + 1, 3 * length, 6 * length])) for _ in range(6)]
    common = some(length // 2)
    texts = [None, "", " \n\t", "one", " ".join(shared[0]), "x " * (5 * length), "x y " * (3 * length), "Ab  cd\té\x0b " * (2 * length)]
    for _ in range(40):
        parts = []
        for _ in range(random.randrange(1, 6)):
            take = list(random.choice(shared))
            if random.random() < 0.3:
                take[random.randrange(len(take))] = "edit"
            parts += random.choice([take, take[: random.randrange(1, len(take) + 1)], some(random.randrange(3 * length)), common])
        texts.append(random.choice([" ", "\n", "  "]).join(parts))
    return texts + texts[:3] + [texts[12]] * 3


@pytest.mark.parametrize("seed,alphabet,length,gram", [(1, 1000, 35, 8), (2, 40, 12, 4), (3, 3, 9, 3), (4, 2, 6, 1)])
def test_equals_brute_force(docs, seed, alphabet, length, gram):
    texts = passages(seed, alphabet, length)
    assert got(docs(texts), length=length, gram=gram) == wanted(list(enumerate(texts)), length)


def test_rows_that_share_an_id_stay_apart(spark):
    a, b = " ".join(f"a{k}" for k in range(90)), " ".join(f"b{k}" for k in range(90))
    rows = [(1, a), (1, a), (1, b), (None, b + " c"), (None, ""), (2, "d " + a)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("key", "t", "z", "anchor", "count")})
    assert got(df) == wanted(rows, 35)


def test_corpus_long_text_and_nothing(spark, docs, corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    assert got(corpus) == wanted(rows, 35)
    long = " ".join(str(k % 30_011) for k in range(60_000))
    assert got(docs([long, "x"])) == wanted([(0, long), (1, "x")], 35)
    empty = substring_dedup.remove_repeats(docs([]))
    assert empty.columns == ["doc_id", "kept", "n_words", "n_removed", "spans"] and empty.count() == 0


def test_paths_are_compacted(docs):
    """A passage without branches is a path or, with the bundles at its ends, a few, whatever its length."""
    passage = " ".join(f"p{k}" for k in range(7000))
    rows = substring_dedup.remove_repeats(docs([f"{n} before {passage} after {n}" for n in range(5)])).collect()
    paths = [sorted((s.start, s.end, s.path) for s in r.spans) for r in rows]
    assert paths.count(paths[0]) == 5 and len(paths[0]) <= 3 and paths[0][0][0] == 1 and paths[0][-1][1] == 7003


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op13_substring_dedup"](spark, SF)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found.collect()) == wanted(rows, 35)
