"""Operators that hold texts against each other, against plain Python."""

import os
import random

import pytest

import brute
import corpus_pipeline
from ledgerlane.llm import decontaminate, jaccard_join, pieces, pii, quality, suffix_dedup
from ledgerlane.llm.components import components

SF = "/root/testdata/sf0.001"


def near_copies(seed=8, groups=12, copies=9):
    random.seed(seed)
    texts = [None, "", " ", "one", "one", "One", "a b c d", "a b c d e", "x " * 500]
    for _ in range(groups):
        base = [random.choice("abcdefghijklmnop") * random.randrange(1, 4) + str(random.randrange(300)) for _ in range(random.choice([5, 8, 12, 20, 60, 150]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(random.randrange(4)):
                own[random.randrange(len(own))] = str(random.randrange(10**6))
            if random.random() < 0.2:
                own = own[: len(own) // 2]
            texts += [" ".join(own)] * random.choice([1, 1, 2])
    return texts


@pytest.mark.parametrize("size,percent,rows,block", [(4, 85, 64, 512), (5, 80, 64, 512), (4, 85, 2, 3)])
def test_jaccard_components(docs, monkeypatch, size, percent, rows, block):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", rows)
    monkeypatch.setattr(jaccard_join, "BLOCK_ROWS", block)
    texts = near_copies()
    got = {r.id: (r.n_shingles, r.component) for r in jaccard_join.jaccard_components(docs(texts), size, percent).collect()}
    assert got == brute.components(list(enumerate(texts)), size, percent)


def test_join_writes_few_bytes_and_slices_batches(docs, monkeypatch):
    """Texts are joined compressed, once and only where candidates want them; the sets of a large batch are never held all at once."""
    held, whole = [], jaccard_join.materialize
    monkeypatch.setattr(jaccard_join, "materialize", lambda df, label, **more: held.append((label, df.columns)) or whole(df, label, **more))
    monkeypatch.setattr(jaccard_join, "SLICE_CHARS", 300)
    monkeypatch.setattr(jaccard_join, "KEPT_SETS", 2)
    texts = near_copies(seed=4)
    got = {r.id: (r.n_shingles, r.component) for r in jaccard_join.jaccard_components(docs(texts), 5, 80).collect()}
    assert got == brute.components(list(enumerate(texts)), 5, 80)
    assert ("wanted-texts", ["id", "z"]) in held and ("wanted", ["id"]) in held
    assert not any("shingles" in columns for _, columns in held)
    long = "word " * 500
    batch = jaccard_join.pa.RecordBatch.from_arrays([jaccard_join.pa.array([1, 2, 3, 4]), jaccard_join.pa.array(["a b", "c", long, "d"])], names=["id", "t"])
    cut = list(jaccard_join._slices([batch]))
    assert [b.column(0).to_pylist() for b in cut] == [[1, 2], [3], [4]]


@pytest.mark.parametrize("percent", [80, 85])
def test_bitmaps_rule_out_no_link(percent):
    """Sets of all sizes that share a part: every pair that links may link, most of those that share little may not."""
    random.seed(percent)
    draw = lambda n: {random.getrandbits(64) for _ in range(n)}
    few = met = 0
    for n in [1, 2, 5, 63, 64, 65, 200, 512, 513, 900, 3000] * 12:
        common, apart = draw(n), random.choice([0.0, 0.02, 0.1, 0.2, 0.25, 1.0])
        x, y = ({*common, *draw(int(n * apart * random.random()))} for _ in range(2))
        if apart == 1.0 and n > 64:
            x, y, few = x - set(sorted(common)[: n // 2]), y, few + 1
        one, two = (jaccard_join.np.array(sorted(s), jaccard_join.np.uint64) for s in (x, y))
        likely = jaccard_join.may_link(jaccard_join.parity(one), jaccard_join.parity(two), len(one), len(two), percent)
        assert likely == jaccard_join.may_link(jaccard_join.parity(two), jaccard_join.parity(one), len(two), len(one), percent)
        assert likely or 100 * len(x & y) < percent * len(x | y)
        met += likely and apart == 1.0 and n > 64
    assert met < few / 4


def test_join_keeps_no_table_that_is_done_with(spark, docs, monkeypatch):
    """Shuffles are let go before the texts are joined; texts, signatures and pairs go once the links are written. Texts are not shuffled for few ids."""
    steps, written, whole = [], {}, jaccard_join.materialize

    def watched(df, label, **more):
        steps.append(label)
        written[label] = whole(df, label, **more)
        if label == "wanted-texts":
            assert "ShuffledHashJoin" not in (plan := df._jdf.queryExecution().executedPlan().toString()) and "BroadcastHashJoin" in plan
        return written[label]

    monkeypatch.setattr(jaccard_join, "materialize", watched)
    monkeypatch.setattr(jaccard_join, "let_go", lambda _: steps.append("let go"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        texts = near_copies(seed=6)
        got = {r.id: (r.n_shingles, r.component) for r in jaccard_join.jaccard_components(docs(texts), 5, 80).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == brute.components(list(enumerate(texts)), 5, 80)
    for label in ("shared-signatures", "candidate-pairs", "wanted-texts", "links"):
        assert steps[steps.index(label) + 1] == "let go"
    left = {label for label, df in written.items() if any(os.path.exists(f.removeprefix("file://")) for f in df.inputFiles())}
    assert left & {"shared-signatures", "candidate-pairs", "likely-pairs", "wanted-texts"} == set() and "set-classes" in left


def test_rows_of_a_group_go_without_a_shuffle_of_texts(spark, docs):
    """Few rows go, so their keys are sent to every task; beyond the bound the texts are shuffled, with the same result."""
    before, bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), jaccard_join.BROADCAST_IDS
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    texts, found = near_copies(seed=7, groups=4), []
    try:
        for most in (bound, 0):
            jaccard_join.BROADCAST_IDS = most
            left = corpus_pipeline.one_of_each_group(spark, docs(texts), "")
            plan = left._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) == (most > 0) and ("Exchange hashpartitioning" in plan) == (most == 0)
            found.append(sorted(r.doc_id for r in left.collect()))
    finally:
        jaccard_join.BROADCAST_IDS = bound
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    heads = brute.components(list(enumerate(texts)), corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    assert found[0] == found[1] == [i for i in range(len(texts)) if heads[i][1] in (i, None)]


def test_small_tables_are_few_files(spark, docs, monkeypatch):
    """Tables of ids do not become a file, which costs two processes on a local disk, for every one of many shuffle partitions."""
    import ledgerlane.llm.components as stars

    files = {}
    for part in (jaccard_join, stars, decontaminate, corpus_pipeline):
        whole = part.materialize
        monkeypatch.setattr(part, "materialize", lambda df, label, whole=whole, **more: files.setdefault(label, whole(df, label, **more)))
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in many}
    for k, v in many.items():
        spark.conf.set(k, v)
    try:
        texts = near_copies(seed=5)
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        items = spark.createDataFrame([(k, texts[k]) for k in range(0, len(texts), 3)], "item_id long, text string")
        heads = brute.components(list(enumerate(texts)), corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
        assert {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, df, "").collect()} == {i for i in range(len(texts)) if heads[i][1] in (i, None)}
        assert decontaminate.drop_contaminated(df, items).count() < len(texts)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    at_most = {"links": 4 * spark.sparkContext.defaultParallelism}
    assert {k: len(x.inputFiles()) for k, x in files.items() if len(x.inputFiles()) > at_most.get(k, spark.sparkContext.defaultParallelism)} == {}


def test_jaccard_of_the_corpus_and_of_nothing(docs, corpus):
    got = {r.id: (r.n_shingles, r.component) for r in jaccard_join.jaccard_components(corpus).collect()}
    assert got == brute.components([(r.doc_id, r.text) for r in corpus.collect()], 4, 85)
    assert jaccard_join.jaccard_components(docs([])).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(500, 499), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 1 for k in range(1, 40)) and got[500] == got[499] == 499


def test_leaks_with_runs_of_one_word_and_null_items(spark, docs):
    """One shingle of a large weight moves the fingerprint far beyond the radius while the similarity stays above 0.8."""
    base = [f"w{k}" for k in range(370)]
    item = " ".join(base + ["run"] * 40)
    texts = ["start " + " ".join(base + ["other"] * 40) + " end", item, "nothing of it", " ".join(base[:200])]
    items = spark.createDataFrame([(None, item), (7, "q " * 60 + " ".join(base[:100]))], "item_id long, text string")
    got = {(r.id, r.item_id): r.similarity for r in decontaminate.contaminated(docs(texts), items).collect()}
    known = [(r.item_id, r.text) for r in items.collect()]
    want = brute.leaks(list(enumerate(texts)), known)
    assert got == pytest.approx(want, abs=2e-6) and {(0, None), (1, None)} <= set(got)
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs(texts), items).collect()} == {2, 3}


def test_leaks(spark, docs, corpus):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    known = [(r.item_id, r.text) for r in items.collect()]
    random.seed(9)
    texts = [None, "", "tiny"]
    for k in range(60):
        w = random.choice(known)[1].split()
        for _ in range(random.randrange(3)):
            w[random.randrange(len(w))] = "changed"
        texts.append(" ".join(["before"] * random.randrange(20) + w[: random.choice([len(w), len(w) - 3])] + ["after"] * random.randrange(20)))
    texts += [known[3][1].upper() + " and " + known[3][1], texts[5]]
    for df in (docs(texts), corpus):
        got = {(r.id, r.item_id): r.similarity for r in decontaminate.contaminated(df, items).collect()}
        assert got == pytest.approx(brute.leaks([(r.doc_id, r.text) for r in df.collect()], known), abs=2e-6)
    kept = decontaminate.drop_contaminated(docs(texts), items)
    assert kept.columns == docs(texts).columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in brute.leaks(list(enumerate(texts)), known)}
    assert decontaminate.contaminated(docs([]), items).count() == 0
    assert decontaminate.contaminated(docs(texts), items.limit(0)).count() == 0


@pytest.mark.parametrize("chunk,hot", [(suffix_dedup.CHUNK, suffix_dedup.HOT), (7, 10**9), (50, 4)])
def test_repeated_byte_strings(docs, chunk, hot):
    random.seed(10)
    passage = "".join(random.choices("abc de", k=400))
    parts = ["a" * 50, "ab" * 60, passage[:150], passage[100:300], passage[250:], "x" * 120, "é😀" * 30]
    texts = ["".join(random.choice([*parts, "".join(random.choices("abcdefgh ", k=80))]) for _ in range(random.randrange(8))) for _ in range(120)]
    texts += [None, "", "q" * 3000, passage, passage]
    cut = suffix_dedup.remove_repeats(docs(texts), chunk=chunk, hot=hot).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, __import__("hashlib").sha256(bytes(r.kept)).hexdigest()) for r in cut}
    assert got == brute.without_repeats(list(enumerate(texts)))


def test_repeats_with_repeated_and_missing_ids(spark, docs):
    text = "".join(random.choices("abcdefgh", k=150))
    df = spark.createDataFrame([(None, text), (1, text), (1, text), (2, text + "z")], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {None: (150, 0), 1: (150, 150), 2: (151, 150)}
    assert suffix_dedup.remove_repeats(docs([])).count() == 0


def test_pipeline_against_plain_python(spark):
    """Stage by stage: what the quality measures, sets and windows of plain Python say."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in quality.quality_rules(docs, ["doc_id"]).filter("kept").collect()}
    assert good <= {r.doc_id for r in rows if not brute.quality(r.text)[5]}
    texts = [(r.doc_id, r.text) for r in rows if r.doc_id in good]
    heads = brute.components(texts, corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT)
    texts = [(i, t) for i, t in texts if heads[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute.leaks(texts, items)}
    want = {i: t for i, t in texts if i not in leaked}
    out = corpus_pipeline.run(spark, SF)
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(want)
    clean = {r.doc_id: r.text for r in pii.redact(docs.filter(docs.doc_id.isin(list(want)))).collect()}
    codec = pieces.codec(corpus_pipeline.tokenizer_file("piece_bpe_32k.model"))
    for i, r in got.items():
        assert r.text == r.decoded_text == clean[i] and r.n_chars == len(r.text) and r.piece_ids == codec.encode(r.text).tolist()


def test_encoding_leaves_no_remembered_stretches():
    """Workers serve other stages after the encoding, which have to do with what it leaves."""
    from ledgerlane.llm.caches import WordCache

    cache = WordCache(lambda words: [len(w) for w in words], 2)
    assert cache.get(["a", "bb"]) == [1, 2] and cache.get(["ccc", "dd"]) == [3, 2] and cache.known and cache.old
    cache.forget()
    assert not cache.known and not cache.old and cache.get(["a"]) == [1]


def test_encoding_leaves_no_codec_in_the_workers(spark, docs):
    """Not only the stretches: the tests of pairs that a codec remembers stay no longer than its task either."""

    def held(batches):
        from ledgerlane.llm import pieces

        for batch in batches:
            yield pieces.pa.RecordBatch.from_arrays([pieces.pa.array([len(pieces._CODECS)] * batch.num_rows, pieces.pa.int64())], names=["n"])

    corpus_pipeline.ship(spark)
    df = docs([f"word{k} and some more of them" for k in range(40)]).repartition(8)
    out = corpus_pipeline.encoded(spark, df, SF)
    assert all(r.decoded_text == r.text for r in out.collect())
    assert {r.n for r in spark.range(0, 64, 1, 8).mapInArrow(held, "n long").collect()} == {0}


def test_stages_stand_edge_cases(spark, docs):
    cases = [None, "", " ", "w " * 30, "w " * 30, "a mail to joe@mail.example.com " * 3]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs(cases), docs([])):
            out = stage(spark, df, SF)
            assert out.columns == df.columns and out.count() <= df.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs(cases), SF).count() == len(cases)


def test_join_stage_keeps_different_texts_under_one_id(spark):
    long, other = " ".join(f"w{k}" for k in range(60)), " ".join(f"v{k}" for k in range(60))
    near = long + " more"
    rows = [(3, long, 1), (7, near, 2), (7, other, 3), (7, other, 4), (None, long, 5), (None, "alone here", 6), (9, "", 7), (9, None, 8), (None, None, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component int").repartition(4)
    out = corpus_pipeline.one_of_each_group(spark, df, SF)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted([(3, long), (7, other), (None, "alone here"), (9, ""), (9, None), (None, None)], key=str)
