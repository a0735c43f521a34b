"""Operators that work text by text, against plain Python and the tokenizer libraries."""

import random
import zlib

import numpy as np
import pytest

import brute
from ledgerlane.llm import caches, chat, language_model, pieces, quality, token_files, toxicity
from ledgerlane.llm.queries import tokenizer_file

EDGE = [None, "", " \n\t", "one", "a b c d e f g h " * 4, "x\n\nx\nx y\n" * 3, "| # $ %% <b> é€😀 " * 5, "the of and to " * 9, "w" * 50_000, "same text again " * 40, "same text again " * 40]


def test_quality_measures(docs, corpus):
    for df in (docs(EDGE), corpus):
        got = {r.doc_id: r for r in quality.quality_rules(df, ["doc_id"]).collect()}
        for r in df.collect():
            g = got[r.doc_id]
            assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == brute.quality(r.text)
            assert not (g.kept and g.base_failed)
    assert quality.keep_good(docs(EDGE)).columns == docs(EDGE).columns
    assert quality.quality_rules(docs([]), ["doc_id"]).count() == 0


def test_quality_filter_cuts_the_words_once(docs):
    """The filter holds one copy of the measures: one split into words, one into lines."""
    plan = quality.keep_good(docs(EDGE))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 2 and plan.count("xxhash64(") <= 4


def test_quality_filter_agrees_with_the_verdicts(docs, corpus):
    for df in (docs(EDGE), corpus):
        kept = {r.doc_id for r in quality.quality_rules(df, ["doc_id"]).filter("kept").collect()}
        assert {r.doc_id for r in quality.keep_good(df).collect()} == kept
    odd = docs(EDGE).selectExpr("doc_id", "text", "1 AS n_words", "2 AS kept", "3 AS `__m`", "4 AS `a.b`")
    assert quality.keep_good(odd).columns == odd.columns


def test_quality_keeps_clean_documents(spark, corpus):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1").select("doc_id")
    judged = quality.quality_rules(corpus, ["doc_id"]).join(labels, "doc_id").filter("NOT base_failed")
    assert judged.filter("kept").count() == judged.count() > 20


def test_planes_and_files_round_trip(tmp_path):
    random.seed(4)
    lots = [[], [5], [0] * 9, list(range(70_000, 70_100)), [random.randrange(1 << 32) for _ in range(1000)]]
    for ids in lots:
        a = np.array(ids, np.uint32)
        assert (token_files.from_planes(token_files.to_planes(a), len(a)) == a).all()
    path = tmp_path / "x.tok"
    writer = token_files.TokenWriter(open(path, "wb"), block_ids=64)
    for k, ids in enumerate(lots):
        writer.add(None if k == 0 else k, np.array(ids, np.uint32))
    writer.close()
    import pyarrow as pa

    with pa.OSFile(str(path)) as source:
        back = list(token_files.TokenReader(source).documents())
    assert [d for d, _ in back] == [None, 1, 2, 3, 4] and [i.tolist() for _, i in back] == lots


def test_token_files_equal_the_library(spark, docs, corpus):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for df in (docs([*EDGE, "A<|endoftext|>b İΣ \x1c\x85"]), corpus):
        manifest, folder = token_files.write_tokens(df, path, 2)
        got = {r.doc_id: r for r in token_files.read_documents(spark, manifest, folder).collect()}
        start = 0
        for r in sorted(df.collect(), key=lambda r: r.doc_id):
            ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2]
            assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)
    manifest, folder = token_files.write_tokens(docs([]), path, 2)
    assert token_files.read_documents(spark, manifest, folder).count() == 0


def test_pieces_equal_the_library():
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), pieces.codec(path)
    random.seed(5)
    parts = ["a", "b", "the", "▁", " ", "  ", "\n", "\t", "é", "😀", "中", "\x00", "</s>", "<0x0A>", "ing", "tion", "aaaa", "1", ".", ",", "ß", "́", "   "]
    texts = ["", "a" * 5000, " " * 5000, " " * 37 + "x", *["".join(random.choices(parts, k=random.randrange(30))) for _ in range(3000)]]
    for t in texts:
        ids = library.encode(t)
        assert own.encode(t).tolist() == ids and own.decode(ids) == library.decode(ids), t[:80]
    for _ in range(2000):
        ids = random.choices([0, 1, 2, 3 + 0xC3, 3 + 0xA9, 3 + 65, 28705, 264, 29351, 1318], k=random.randrange(9))
        assert own.decode(ids) == library.decode(ids), ids


def test_piece_documents(docs):
    path = tokenizer_file("piece_bpe_32k.model")
    out = pieces.encode_documents(docs(EDGE), path)
    assert out.columns == [*docs(EDGE).columns, "piece_ids", "decoded_text"]
    for r in out.collect():
        assert r.decoded_text == (r.text or "") and r.spans == "x"
    assert pieces.digest_documents(docs([]), path).count() == 0


def test_chat_round_trip_and_masks(spark):
    random.seed(6)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<", "[", "/", " ", "\n", "é", "😀", ".", "]", "<|endoftext|>"]
    rows, want = [], {}
    for c in range(200):
        turns = [(k, random.choice(["user", "assistant", None, "<s>x"]), random.choice([None, "", "".join(random.choices(parts, k=random.randrange(12)))])) for k in range(random.randrange(1, 5))]
        rows += [(c, *t) for t in turns]
        want[c] = [(r or "", t or "") for _, r, t in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df, tokenizer_file("byte_bpe_50k.json"))
    for r in chat.digests(out).collect():
        loss = "".join(t for role, t in want[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(want[r.conv_id]), brute.sha("".join(f"{a}\n{b}\n" for a, b in want[r.conv_id])))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), brute.sha(loss))
    assert chat.digests(chat.format_conversations(df.limit(0), tokenizer_file("byte_bpe_50k.json"))).count() == 0


def test_toxicity_learns_and_forgives_misspelling(spark, docs):
    random.seed(7)
    usual = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "magna", "aliqua", "veniam", "quis"]
    texts = [" ".join(random.choices(usual, k=40)) + (" you stupid idiot " if k % 4 == 0 else " you kind friend ") + " ".join(random.choices(usual, k=20)) for k in range(240)]
    df = docs([*texts, None, "", "such a stupiid idiiot " + " ".join(usual)])
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(240)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(df, labels).collect()}
    held = [k for k in range(240) if zlib.crc32(str(k).encode()) % 5 == 0]
    assert all(got[k].held_out == (k in held) for k in range(240))
    assert sum(got[k].predicted == int(k % 4 == 0) for k in held) >= 0.95 * len(held)
    assert got[242].score > max(got[k].score for k in range(240) if k % 4) and 0 <= got[240].score <= 1 and got[240].score == got[241].score
    assert toxicity.score_documents(docs([]), labels).count() == 0
    none = toxicity.score_documents(df, labels.limit(0)).collect()
    assert {r.predicted for r in none} == {0}


def test_toxicity_looks_at_all_of_a_long_run(spark, docs):
    """A toxic word far inside a run without white space counts, in any script."""
    for n in (64, 65, 71, 72, 73, 100, 1000):
        run = "".join(chr(0x4E00 + k) for k in range(n))
        words = [w.decode() for w in toxicity.words_of(f"a {run} b")]
        held = {run[k : k + size] for size in toxicity.GRAMS for k in range(n - size + 1)}
        assert all(any(g in w for w in words) for g in held) and max(map(len, words)) <= toxicity.RUN
    random.seed(7)
    usual = ["lorem", "ipsum", "dolor", "amet", "sit", "elit", "magna", "aliqua", "veniam", "quis"]
    texts = [" ".join(random.choices(usual, k=40)) + (" you stupid idiot " if k % 4 == 0 else " you kind friend ") + " ".join(random.choices(usual, k=20)) for k in range(240)]
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(240)], "doc_id long, toxic int")
    runs = []
    for mark in ("_", ".", "\u00a0", "\u200b"):
        harmless = mark.join(usual * 2)
        assert len(harmless) > 100
        runs += [harmless + mark + "kind" + mark + "friend", harmless + mark + "stupid" + mark + "idiot"]
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs([*texts, *runs]), labels).collect()}
    assert all(got[k + 1] > 2 * got[k] and got[k + 1] > got[k] + 0.1 for k in range(240, 240 + len(runs), 2)), [got[k] for k in range(240, 240 + len(runs))]


def test_language_model_base_and_gain(docs, corpus):
    import math
    from collections import Counter

    for df in (docs([*EDGE, "a\x00b é", "The THE the"]), corpus):
        rows = df.collect()
        told = {r.doc_id: [*brute.words(r.text, low=True), None] for r in rows}
        counts = Counter()
        for i, w in told.items():
            if zlib.crc32(str(i).encode()) % 10:
                counts.update(w)
        n, v = sum(counts.values()), len(counts)
        for r in language_model.score_documents(df).collect():
            w = told[r.doc_id]
            base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(counts[x] > 0 for x in w), n)
            assert r.base_score == pytest.approx(base) and r.score < 0 and math.isfinite(r.score)
    assert language_model.score_documents(docs([])).count() == 0


def test_spelled_words_are_a_distribution():
    """Over all bytes at one place, the chances add up to one."""
    mixer = language_model.Mixer(np.random.default_rng(1).integers(0, 5, (language_model.ORDERS, language_model.SLOTS, 2)).astype(np.float32))
    heads = [b"ab" + bytes([k]) for k in range(256)]
    d = language_model.Decisions(heads)
    x, gate = mixer.inputs(d)
    p = mixer.chance(x, gate)
    p = np.where(d.bits == 1, p, 1 - p).reshape(-1, 8)
    third = p.reshape(256, 4, 8)[:, 2].prod(axis=1)
    assert third.sum() == pytest.approx(1)


def test_refined_scores_are_a_distribution():
    """Over all next words the probabilities add up to one."""
    spelled, common = np.log10([0.2, 0.3, 0.5]), np.array([0.5, 0.5, 0.0])
    for head in ([], [0], [0, 1, 0], [2, 2]):
        of = [10 ** language_model.refined(spelled[w := np.array([*head, k])], common[w], w) for k in range(3)]
        before = 10 ** language_model.refined(spelled[w := np.array(head, int)], common[w], w) if head else 1
        assert sum(of) == pytest.approx(before)


def test_long_unseen_words_cost_in_proportion_to_their_length(docs):
    """Nothing of a long word goes unscored."""
    for length in (200, 400, 800, 1600):
        alone = np.array([-2.0 * length])
        assert language_model.refined(alone, np.zeros(1), np.zeros(1, int)) == pytest.approx(alone[0] + np.log10(0.1))
    texts = ["some plain words to learn from"] * 20 + ["".join(chr(33 + k * k * 31 % 89 + (k // 89) % 5) for k in range(n)) for n in (2000, 4000, 8000)]
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    df = docs(["some plain words to learn from"] * 100)
    rows = [(r.doc_id, texts[20 + ids.index(r.doc_id)] if r.doc_id in ids else r.text) for r in df.collect()]
    got = {r.doc_id: r for r in language_model.score_documents(df.sparkSession.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].held_out for i in ids)
    rates = [got[i].bits_per_byte for i in ids]
    assert min(rates) > 1 and max(rates) < 1.1 * min(rates)


def test_counts_of_contexts_are_exact_at_any_size(spark):
    """Every context keeps its own zeros and ones, however many there are."""
    from collections import Counter

    words = [f"{k * 7919 % 100_000:05d}{k % 13}x".encode() for k in range(60_000)] + [language_model.END, b"aaaa"]
    told = [k % 4 for k in range(len(words))]
    want, contexts = Counter(), set()
    for w, c in zip(words, told):
        spelled = w if w == language_model.END else w + b" "
        for at, byte in enumerate(spelled):
            bits = f"{byte:08b}"
            for j in range(8):
                want[spelled[:at], bits[:j], int(bits[j])] += c
                contexts.add((spelled[:at], bits[:j]))
    assert len(contexts) > 2 * language_model.SLOTS
    chunks = language_model.word_chunks(spark.createDataFrame(list(zip(words, told)), "word binary, c long").repartition(3))
    seen = 0
    for r in language_model.context_counts(chunks, 8).collect():
        mine = [bytes(w) for w in r.words]
        d = language_model.Decisions(mine)
        counts = language_model.Mixer.of(d, r.counts, None).counts[-1][d.slots[-1]].reshape(-1, 8, 2)
        n = 0
        for w in mine:
            spelled = w if w == language_model.END else w + b" "
            for at in range(len(spelled)):
                bits = f"{spelled[at]:08b}"
                assert [tuple(x) for x in counts[n]] == [(want[spelled[:at], bits[:j], 0], want[spelled[:at], bits[:j], 1]) for j in range(8)]
                n += 1
        seen += len(mine)
    assert seen == len(words) and language_model.ORDERS == 5


def test_cache_is_bounded_and_right():
    cache = caches.WordCache(lambda words: [w.upper() for w in words], limit=50)
    for k in range(20):
        words = [str(k * 7 % 13 + j) + "x" for j in range(30)] + ["y" * 300]
        assert cache.get(words) == [w.upper() for w in words] and len(cache.known) <= 50


def test_tokens_of_a_batch_are_those_of_its_texts():
    """Words as hashes, without strings: a word never goes on into the next text, and every text has its end."""
    import zstandard

    texts = [t.encode() for t in ["one two", "two", "", " ", "One\x0btwo\x0c", "", "é\x00x", "\x1ctail", "last " * 3, "a" * 600_000, "z"]]
    for some in (texts, texts[::-1], [b""], [b"", b"", b"word"]):
        hashes, place, stops = language_model._dictionary([len(t) for t in some], zstandard.ZstdCompressor(1).compress(b"".join(some)))
        assert (np.diff(hashes.astype(object)) > 0).all() and len(stops) == len(some) and stops[-1] == len(place)
        for text, got in zip(some, np.split(place, stops[:-1])):
            assert hashes[got].tolist() == language_model.hash_words([*language_model.tokens(text), language_model.END]).tolist()


def _texts_of_known_words():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(words[k] for k in np.minimum(rng.zipf(1.4, int(rng.integers(0, 60))), 40) - 1) for _ in range(60)]
    return [" ".join(words), *texts, *[f"{words[k % 40]} {words[k * 7 % 40]} {words[k * 3 % 40]}" for k in range(80)], None]


def test_known_words_are_mixed_along_the_text(docs, spark):
    """Decision by decision in plain Python: contexts reach two words back, and weights step along the text."""
    import math
    from collections import Counter

    texts = _texts_of_known_words()
    df = docs(texts)
    trained = [zlib.crc32(str(i).encode()) % 10 != 0 for i in range(len(texts))]
    told = [[*brute.words(t, low=True), "\n"] for t in texts]
    counts = Counter(w for t, ok in zip(told, trained) if ok for w in t)
    table = spark.createDataFrame([(w.encode(), c) for w, c in [*counts.items(), ("unseen", 0)]], "word binary, c bigint")
    numbers = {bytes(r.word).decode(): r.number for r in language_model.numbered_words(table, dict(Counter(counts.values())), 4).collect()}
    assert sorted(numbers.values()) == list(range(1, len(counts) + 1))
    assert all(counts[v] >= counts[w] for v in numbers for w in numbers if numbers[v] < numbers[w])

    def path(w):
        size = numbers[w].bit_length() - 1
        return f"{size:05b}" + f"{numbers[w]:b}"[1:]

    def context(words, t, reach):
        return tuple(["\n", *words[:t]][-reach:]) if t >= reach - 1 else None

    follow = Counter()
    for words, ok in zip(told, trained):
        for t, w in enumerate(words):
            for at in range(len(path(w)) + 1) if ok else ():
                for place in ((), *((r, context(words, t, r)) for r in (1, 2))):
                    follow[place, path(w)[:at]] += 1
    odds = lambda a, b: math.log(a + 0.05) - math.log(b + 0.05)
    total, once, start = sum(counts.values()), sum(c == 1 for c in counts.values()), language_model.start_weights()
    got = {r.doc_id: r.score for r in language_model.score_documents(df).collect()}
    for i, words in enumerate(told):
        if any(w not in counts for w in words):
            continue
        weights, own, score, steps = start.copy(), Counter(), 0.0, np.zeros_like(start)
        for t, w in enumerate(words):
            cases = [(0, [odds(t, 0), odds(total - once, once), 0.0, 0.0])]
            for at in range(len(path(w))):
                node, taken = path(w)[:at], path(w)[: at + 1]
                if follow[(), node] == follow[(), taken]:
                    continue
                ways = [(own[taken], own[node] - own[taken])]
                ways += [(follow[p, taken], follow[p, node] - follow[p, taken]) for p in ((), *((r, context(words, t, r)) for r in (1, 2)))]
                x = [odds(*way) for way in ways]
                cases.append((1 + (at >= 5), x[:2] + [round(v * 512) / 512 for v in x[2:]]))
            for kind, x in cases:
                gate = (kind * 3 + (abs(x[3]) > 0) + (abs(x[3]) > 3.1)) * 3 + (abs(x[2]) > 0) + (abs(x[2]) > 3.1)
                mixed = min(16, max(-16, float(np.dot(x, weights[gate]))))
                score -= math.log1p(math.exp(-mixed)) / math.log(10)
                steps[gate] += 0.02 * np.array(x) / (1 + math.exp(mixed))
            for at in range(len(path(w)) + 1):
                own[path(w)[:at]] += 1
            if t % 8 == 7:
                weights, steps = weights + steps, np.zeros_like(start)
        assert got[i] == pytest.approx(score, rel=1e-4, abs=1e-4), (i, words)


def test_scores_know_the_word_before(spark):
    """The same words in an order that training texts have are likelier than in another one."""
    usual, other = "one small cat sat here and one big dog ran there", "there cat one and sat dog here big one small ran"
    assert sorted(usual.split()) == sorted(other.split())
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    rows = [(k, usual if k not in held or k == held[0] else other) for k in range(200)]
    got = {r.doc_id: r.score for r in language_model.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held[0]] > got[held[1]] + 5


def test_scores_do_not_depend_on_the_partitions(corpus):
    some = corpus.limit(300).select("doc_id", "text").collect()
    df = corpus.sparkSession.createDataFrame(some, "doc_id long, text string")
    conf, got = df.sparkSession.conf, []
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [conf.get(name) for name in names]
    try:
        for n in (4, 13):
            for name, value in zip(names, (str(n), "false")):
                conf.set(name, value)
            got.append({r.doc_id: r.score for r in language_model.score_documents(df.repartition(n)).collect()})
    finally:
        for name, value in zip(names, before):
            conf.set(name, value)
    assert got[0] == got[1] and len(got[0]) == len(some)


def test_next_words_are_a_distribution():
    """Without contexts seen, all known words and the unknown one add up to one after any text."""
    shares = language_model.Shares({50: 1, 7: 5, 3: 10, 1: 21})
    none = lambda n: [np.zeros((shares.depths, n), np.int16)] * language_model.REACH
    score = lambda w, stops: 10 ** language_model.known_scores(w, stops, shares.odds(np.maximum(w, 1)), none(len(w)), shares)
    for head in ([], [3], [1, 0, 37, 0, 1, 1, 2, 9, 30, 1], [37] * 20):
        tails = np.array([[*head, k] for k in range(38)])
        before = score(np.array(head), np.array([len(head)]))[0] if head else 1.0
        assert score(tails.ravel(), np.arange(1, 39) * (len(head) + 1)).sum() == pytest.approx(before, rel=1e-4)


def test_language_model_keeps_no_table_it_has_read(docs, monkeypatch):
    """Tables that a later one holds as well do not lie beside it until the end of the run."""
    import os

    held, whole = {}, language_model.materialize
    monkeypatch.setattr(language_model, "materialize", lambda df, label, **more: held.setdefault(label, whole(df, label, **more)))
    rows = language_model.score_documents(docs(["a b c a b", "b c d", None, "zz a b"] * 6)).collect()
    left = {label: [p for p in df.inputFiles() if os.path.exists(p.split(":", 1)[1])] for label, df in held.items()}
    assert len(rows) == 24 and all(r.score < 0 for r in rows)
    assert {label for label, files in left.items() if files} == {"word-values"} and len(left) > 3


def test_long_texts_are_scored_in_bounded_memory():
    """What lies in memory for a token does not include all inputs of all its decisions at once."""
    import tracemalloc

    n = 1 << 16
    shares = language_model.Shares({50: 1, 7: 500, 3: 10_000, 1: 200_000})
    numbers = np.random.default_rng(3).integers(0, shares.words + 1, n)
    large, none = shares.odds(np.maximum(numbers, 1)), np.zeros((shares.depths, n), np.int16)
    tracemalloc.start()
    try:
        score = language_model.known_scores(numbers, np.array([n]), large, [none] * language_model.REACH, shares)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.isfinite(score).all() and score[0] < 0 and peak < 600 * n


def test_answers_hold_the_odds_of_every_decision():
    """What a batch is told of its keys gives the log-odds of plain counting, though most decisions are left out."""
    import math
    from collections import Counter

    rng = np.random.default_rng(9)
    contexts, numbers = np.minimum(rng.zipf(1.3, 4000), 400), np.minimum(rng.zipf(1.3, 4000), 900)
    keys, counts = np.unique(contexts.astype(np.uint64) << np.uint64(32) | numbers.astype(np.uint64), return_counts=True)
    counts = np.where(rng.random(len(keys)) < 0.2, 0, counts * np.where(rng.random(len(keys)) < 0.05, 5000, 1))
    depths = language_model.LENGTH_BITS + 10
    path = lambda w: f"{w.bit_length() - 1:05b}" + f"{w:b}"[1:]
    pairs, follow = [(int(k) >> 32, path(int(k) & 0xFFFFFFFF)) for k in keys], Counter()
    for (c, way), n in zip(pairs, counts):
        for at in range(len(way) + 1):
            follow[c, way[:at]] += int(n)
    odds = lambda a, b: round((math.log(a + 0.05) - math.log(b + 0.05)) * 512)
    want = [[odds(follow[c, way[: at + 1]], follow[c, way[:at]] - follow[c, way[: at + 1]]) for at in range(len(way))] + [0] * (depths - len(way)) for c, way in pairs]
    tables = language_model.path_odds(keys, counts, depths)
    for some in (np.arange(len(keys)), np.flatnonzero(rng.random(len(keys)) < 0.3), np.arange(1), np.arange(0)):
        sent = language_model._sent_odds(keys[some], *(x[some] for x in tables))
        assert language_model.odds_from(sent, keys[some], depths).tolist() == [want[k] for k in some]


def test_word_values_are_joined_as_they_lie(docs, monkeypatch):
    """The last phase shuffles keys and answers, not the texts again."""
    rows = []
    whole = language_model.followed
    monkeypatch.setattr(language_model, "followed", lambda *x: rows.append(whole(*x)) or rows[0])
    language_model.score_documents(docs(["a b c a b", "b c d", None, "zz a b"] * 6))
    plan = rows[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
