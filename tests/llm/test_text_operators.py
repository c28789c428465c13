"""Substring dedup, Jaccard join, decontamination, BPE, language ID and the language model against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skillgauge.llm import bpe, decontaminate, hmm, jaccard_join, language_id, substring_dedup
from skillgauge.llm import words as W
from tests.llm.cases import DOCS, corpus, documents, lowered, words


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(docs):
    """Extra columns named like internal ones."""
    return docs.withColumns({c: F.lit("x") for c in ("n", "key", "bucket", "body", "uid", "id", "line", "held_out", "row", "gone", "component")})


def test_word_hashes_follow_the_byte_class():
    texts = [b"A b\tB", b"", b"  ", b"long" * 600_000 + b" b", b"b"]
    flat, begins = W.hash_words(texts, W.SPACED_LOWER)
    assert begins.tolist() == [0, 3, 3, 3, 5, 6]
    assert flat[1] == flat[2] == flat[4] == flat[5] and flat[0] != flat[1]
    assert W.hash_words([b"x-Y_z1\xc3\xa9!"], W.ALNUM_LOWER)[1].tolist() == [0, 3]


def test_lookup_finds_all_and_only_its_keys():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000, dtype=np.uint64)
    keys = np.unique(np.append(keys, np.uint64(0)))
    table = W.Lookup(keys)
    assert (table.find(keys) == np.arange(len(keys))).all()
    assert (table.find(keys + np.uint64(1 << 63)) == -1).all()


def removed(rows, size=13):
    first = {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        own = words(text)
        for k in range(len(own) - size + 1):
            first.setdefault(tuple(own[k : k + size]), doc_id)
    out = {}
    for doc_id, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - size + 1):
            if first[tuple(own[k : k + size])] < doc_id:
                gone[k : k + size] = [True] * size
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out[doc_id] = (len(own), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode())
    return out


@pytest.mark.parametrize("cells", [1 << 29, 1 << 4])  # the small sketch is full: everything passes it
def test_substring_dedup(spark, cells):
    rows = corpus()
    got = substring_dedup.substring_dedup(clashing(documents(spark, rows)), max_cells=cells).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == removed(rows)


def test_substring_dedup_ids(spark):
    text = " ".join(f"w{k}" for k in range(15))
    rows = documents(spark, [(1, "short"), (7, text), (7, text), (9, text), (None, text)])
    got = sorted((r.doc_id is None, r.doc_id, r.n_removed) for r in substring_dedup.substring_dedup(rows).collect())
    assert got == [(False, 1, 0), (False, 7, 0), (False, 7, 0), (False, 9, 15), (True, None, 15)]
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0


def jaccard(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        own = lowered(text)
        sets[doc_id] = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} or ({tuple(own)} if own else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (1, 60)])
def test_jaccard_components(spark, size, percent):
    rows = corpus(seed=2)
    got = jaccard_join.jaccard_components(clashing(documents(spark, rows)), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == jaccard(rows, size, percent)


def test_jaccard_chain_of_near_copies(spark):
    """Each text is near the next one only; a first look at one centre is not enough."""
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join([f"v{j}" for j in range(k * 2)] + base[k * 2 :])) for k in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(documents(spark, rows)).collect()}
    assert got == {d: c for d, (_, c) in jaccard(rows, 3, 90).items()}


def test_jaccard_ids(spark):
    got = jaccard_join.jaccard_components(documents(spark, [(5, "a b c d"), (3, "A B C D"), (None, "a b c d"), (4, None), (4, "  ")])).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in got) == [(-1, 2, None), (3, 2, 3), (4, 0, 4), (4, 0, 4), (5, 2, 3)]
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def alnum(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", b" ".join((text or "").encode().translate(bytes(
        b + 32 if 65 <= b <= 90 else b for b in range(256))).split(b" ")))


def contaminated(rows, items, window=13):
    runs = {}
    for item, text in items:
        own = alnum(text)
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            runs.setdefault(tuple(own[k : k + n]), set()).add(str(item))
    out = {}
    for doc_id, text in rows:
        own, found = alnum(text), set()
        hit = [False] * len(own)
        for n in {len(r) for r in runs}:
            for k in range(len(own) - n + 1):
                if tuple(own[k : k + n]) in runs:
                    found |= runs[tuple(own[k : k + n])]
                    hit[k : k + n] = [True] * n
        n_hit = sum(hit)
        out[doc_id] = (len(own), n_hit, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= len(own))
    return out


def test_contamination(spark):
    rows = corpus(seed=3)
    items = [(k, rows[k * 6 + 3][1]) for k in range(8)] + [(8, "one"), (9, "Two, WORDS!"), (10, None), (11, ""), (12, "no such short item"), (13, rows[3][1])]
    rows += [(900, "prefix " + " ".join(str(rows[3][1]).split()[-13:]) + " suffix"), (901, " ".join(str(rows[3][1]).split()[-12:]) + " other")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("id", F.lit(1))
    got = decontaminate.contamination(clashing(documents(spark, rows)), bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got} == contaminated(rows, items)
    kept = decontaminate.decontaminate(clashing(documents(spark, rows)), bench)
    assert {r.doc_id for r in kept.collect()} == {d for d, v in contaminated(rows, items).items() if not v[4]}
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(documents(spark, rows[:3]), bench.limit(0)).collect()} == {0}


@pytest.mark.parametrize("width", [1, 2, 5, 9])
def test_winnowing_marks_every_window(width):
    hashes = np.random.default_rng(width).integers(0, 50, 300).astype(np.uint64)
    chosen = set(decontaminate.winnow(hashes, width).tolist())
    for k in range(len(hashes) - width + 1):
        assert any(j in chosen and hashes[j] == hashes[k : k + width].min() for j in range(k, k + width))


TRICKY = ["Hello World's  été 12 <|endoftext|> x", "", "İstanbul ß ǅ ΩÅ é 'S 'll ΟΔΟΣ Σ", "a\x00b \x1c\x85​ z ٣ ½ ² 漢字😀😀",
          "x" * 500 + "yz" * 300, "<|startoftext|><|endoftext|>a<b", "!!!???...///" * 40, "antidisestablishmentarianism" * 3, "été"]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(bpe.default_path())
    rows = corpus(seed=4) + [(800 + k, t) for k, t in enumerate(TRICKY)]
    path = bpe.default_path()
    got = {r.doc_id: r for r in bpe.decode(bpe.encode(clashing(documents(spark, rows)), path), path).collect()}
    for doc_id, text in rows:
        expected = own.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[doc_id].ids), dtype="<u4").tolist() == expected
        assert got[doc_id].decoded == own.decode(expected, skip_special_tokens=False)
    assert bpe.token_digests(empty(spark)).count() == 0


def test_bpe_long_and_short_words_merge_alike():
    model = bpe.Model(bpe.default_path())
    for word in (b"internationalisation", "größenverhältnisse".encode(), b"aaaaaaaaaaaaaaaa", b"thethethe"):
        parts = model.inner[np.frombuffer(word, dtype=np.uint8)]
        parts[-1] = model.last[word[-1]]
        assert model.merge_long(parts).astype("<u4").tobytes() == model.encode_words([word])[0]


def test_language_id(spark):
    english, german = "the cat and the dog were there with them", "der hund und die katze waren nicht überall dort"
    rows = [(k, f"{english} {k}", "en") for k in range(10)] + [(20 + k, f"{german} {k}", "de") for k in range(10)]
    filters = language_id.train(documents(spark, rows))
    asked = documents(spark, [(1, "The Dog"), (2, "KATZE nicht"), (3, None), (4, "123 !?"), (5, "漢字"), (None, "und die"), (7, english * 20_000), (7, "")])
    got = [tuple(r) for r in language_id.identify(clashing(asked), filters).collect()]
    assert [(g[0], g[1]) for g in got] == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, filters.langs[0]), (None, "de"), (7, "en"), (7, "und")]
    assert all(0 <= g[2] <= 1 for g in got)
    assert {r.doc_id for r in language_id.keep_identified(clashing(asked), filters).collect()} == {1, 2, None, 7}
    nothing = language_id.train(empty(spark))
    assert [r.lang_pred for r in language_id.identify(asked, nothing).collect()] == ["und"] * 8


def test_language_id_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from skillgauge.llm.queries import QUERIES

    got = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.001").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert got and sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)


def test_language_model_base_and_counts(spark):
    rows = corpus(seed=5)
    docs = documents(spark, rows).withColumn("held_out", F.coalesce(W.crc_class(5) == 1, F.lit(False))).withColumn("n", F.lit(1))
    got = {r.doc_id: r for r in hmm.language_model_scores(docs).collect()}
    tokens = {d: [*lowered(t), None] for d, t in rows}
    counts = Counter()
    for doc_id, own in tokens.items():
        if zlib.crc32(str(doc_id).encode()) % 5 != 1:
            counts.update(own)
    total, distinct = sum(counts.values()), len(counts)
    for doc_id, own in tokens.items():
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        r = got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(doc_id).encode()) % 5 == 1, len(own), sum(counts[t] > 0 for t in own), total)
        assert r.base_score == pytest.approx(base, rel=1e-12)
        assert r.score < 0 and math.isfinite(r.score)


def test_forward_recursion_sums_over_all_paths():
    rng = np.random.default_rng(3)
    emit = np.full((hmm._N_SYMBOLS, 2), 1e-9)
    emit[:4] = rng.random((4, 2))
    move, start = rng.random((2, 2)), rng.random(2)
    model = hmm.Model(start, move, emit)
    texts = [np.array(t) for t in ([0], [1, 2, 3], [3, 3, 0, 1, 2], [2])]
    for text, got in zip(texts, model.log_likelihoods(texts)):
        total = 0.0
        for path in np.ndindex(*[2] * len(text)):
            p = start[path[0]] * emit[text[0], path[0]]
            for t in range(1, len(text)):
                p *= move[path[t - 1], path[t]] * emit[text[t], path[t]]
            total += p
        assert got == pytest.approx(math.log(total))


@pytest.mark.parametrize("span", [1, 2, 64])
def test_expected_counts_agree_with_all_paths(monkeypatch, span):
    monkeypatch.setattr(hmm, "_SPAN", span)
    rng = np.random.default_rng(4)
    emit = np.full((hmm._N_SYMBOLS, 2), 1e-9)
    emit[:3] = rng.random((3, 2))
    move, start = rng.random((2, 2)), rng.random(2)
    texts = [np.array(t) for t in ([0, 1, 2], [2, 1], [1], [2, 0, 0, 1, 2, 1, 0])]
    first, moves, emits = np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for text in texts:
        paths = {}
        for path in np.ndindex(*[2] * len(text)):
            p = start[path[0]] * emit[text[0], path[0]]
            for t in range(1, len(text)):
                p *= move[path[t - 1], path[t]] * emit[text[t], path[t]]
            paths[path] = p
        whole = sum(paths.values())
        for path, p in paths.items():
            first[path[0]] += p / whole
            for t, s in enumerate(path):
                emits[text[t], s] += p / whole
                if t:
                    moves[path[t - 1], s] += p / whole
    got = hmm.Model(start, move, emit).expected(texts)
    assert np.allclose(got[0], first) and np.allclose(got[1], moves) and np.allclose(got[2][:3], emits)


def test_counts_by_centre_cover_all_texts():
    rng = np.random.default_rng(5)
    log = rng.normal(size=(hmm._N_SYMBOLS, 3))
    texts = [rng.integers(0, 6, n).astype("<u2") for n in (1, 4, 9, 30, 2)]

    class Shared:
        value = log

    batch = pa.RecordBatch.from_pydict({"symbols": pa.array([t.tobytes() for t in texts], pa.binary())})
    (out,) = hmm._assign(Shared)([batch])
    sums = dict(zip(out.column("shard").to_pylist(), out.column("sums").to_pylist()))
    best = [int(np.argmax([sum(log[w, s] for w in t) for s in range(3)])) for t in texts]
    wanted = np.zeros((6, 3))
    for t, s in zip(texts, best):
        for w in t:
            wanted[w, s] += 1
    assert np.frombuffer(sums[0]).reshape(-1, 3)[:6].tolist() == wanted.tolist()
    assert np.frombuffer(sums[-1])[:3].tolist() == [best.count(s) for s in range(3)]


def test_frequent_words_fill_the_table_where_one_count_alone_exceeds_it(spark):
    counts = spark.range(20_000).select(F.xxhash64("id").alias("word"), F.when(F.col("id") < 100, 5).otherwise(1).cast("long").alias("c"))
    got = hmm.frequent_words(counts, 5000).agg(F.count(F.lit(1)), F.sum((F.col("c") == 5).cast("int"))).first()
    assert 4000 < got[0] <= 5000 and got[1] == 100
    assert hmm.frequent_words(counts, 20_000).count() == 20_000 and hmm.frequent_words(counts.limit(0), 10).count() == 0


def test_language_model_beats_the_base_on_held_out_texts(spark):
    from skillgauge.llm.queries import QUERIES

    got = QUERIES["op10_hmm"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_language_model_without_training_rows(spark):
    docs = documents(spark, [(1, "a b"), (2, None)]).withColumn("held_out", F.lit(True))
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in hmm.language_model_scores(docs).collect()} == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert hmm.language_model_scores(empty(spark).withColumn("held_out", F.lit(False))).count() == 0
