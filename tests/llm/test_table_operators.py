"""Vector search, WARC, token counts, line dedup, components and the pipeline against brute force."""

import base64
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillgauge.llm import line_dedup, token_rollup, vector_search, warc
from skillgauge.llm import words as W
from skillgauge.llm.components import components
from tests.llm.cases import DOCS, corpus, documents


def test_components_of_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 130)] + [(200, 200), (301, 300), (300, 301)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 130)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def brute_top(rows, k=5, every=50):
    whole = {}
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own = [int(math.floor(256.0 * x)) for x in v]
            whole[vec_id] = own
    out = []
    for q in whole:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in whole if c != q)[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored, 1)]
    return sorted(out)


def search(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit(1), "ring": F.lit("x")})
    return sorted(tuple(r) for r in vector_search.top_k(frame, F.col("vec_id") % 50 == 0).collect())


def test_vector_search_with_clusters_ties_and_bad_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(k, (rng.normal(size=8) + 5 * (k % 3)).tolist()) for k in range(700)]
    rows += [(k, rows[4][1]) for k in range(700, 1500)]  # one vector in half of all rows
    rows += [(1500, None), (1501, [1.0, None] + [0.0] * 6), (1502, [float("nan")] * 8), (1550, [float("inf")] * 8), (1600, [-1e9] * 8), (1601, [1e9] * 8),
             (1650, []), (1651, [0.5])]
    assert search(spark, rows) == brute_top(rows)


def test_vector_search_with_huge_components(spark):
    """One huge vector must not spoil the others' results; scores beyond a long are cut and tie."""
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(300)]
    rows += [(300, [1e200] + [0.0] * 5), (301, [-1e200] + [1.0] * 5), (302, [0.0, 1e305] + [0.0] * 4), (303, [1e308] * 6), (304, [0.0, 0.0, 1e19, 0.0, 0.0, 0.0])]
    top = np.iinfo(np.int64)
    small = [(i, v) for i, v in rows if i != 303]  # overflows once scaled
    whole = {i: [int(math.floor(256.0 * x)) for x in v] for i, v in small}
    wanted = []
    for q in (i for i in whole if i % 50 == 0):
        score = {c: min(max(sum(a * b for a, b in zip(whole[q], whole[c])), top.min), top.max) for c in whole if c != q}
        wanted += [(q, rank, c, score[c]) for rank, c in enumerate(sorted(score, key=lambda c: (-score[c], c))[:5], 1)]
    assert search(spark, rows) == sorted(wanted)


def test_vector_search_on_few_rows(spark):
    assert search(spark, []) == []
    assert search(spark, [(50, [1.0])]) == []
    assert search(spark, [(50, [1.0]), (7, [1.0]), (3, [-1.0]), (None, [1.0])]) == [(50, 1, 7, 65536), (50, 2, 3, -65536)]
    assert search(spark, [(0, [1.0]), (0, [1.0]), (7, [2.0])]) == [(0, 1, 7, 131072)]


PAGES = "page_id long, url string, html string"


def test_warc_round_trip(spark):
    html = ["<p>a</p>", "<p>b</p>\r\n\r\nWARC/1.1\r\n", None, "", "é漢😀\r\n\r\n\r\n", "x" * 300_000]
    rows = [(k, f"http://h/{k}\r\nX: y", html[k % len(html)]) for k in range(40, 0, -1)] + [(99, None, "single"), (None, "u", "single"), (None, "u", "none"), (3, "u", html[3])]
    pages = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit("x")).withColumn("first", F.lit(1))
    got = warc.captures(pages).collect()
    least = {}
    for page_id, _, text in rows:
        key = text or ""
        if page_id is not None:
            least[key] = min(page_id, least.get(key, page_id))
    expected = []
    for page_id, _, text in rows:
        own = (text or "").encode()
        first = least.get(text or "")
        again = first is not None and (page_id is None or page_id > first)
        expected.append((page_id, len(own), base64.b32encode(hashlib.sha1(own).digest()).decode(), "revisit" if again else "response", first if again else None))
    order = lambda x: [str(y) for y in x]
    mine = [(r.response.page_id, r.response.payload_bytes if r.response.payload_bytes is not None else r.metadata[0].payload_bytes,
             r.response.payload_digest, r.response.type, r.response.refers_to) for r in got]
    assert sorted(mine, key=order) == sorted(expected, key=order)
    payloads = {r.response.page_id: bytes(r.response.payload) for r in got if r.response.type == "response" and r.response.page_id}
    texts = {p: (t or "").encode() for p, _, t in rows}
    assert all(payloads[p] == texts[p] for p in payloads)
    assert all(len(r.requests) == len(r.metadata) == 1 for r in got)
    from skillgauge.llm.queries import QUERIES  # the query derives its columns from the same rows

    assert QUERIES["op3_warc"](spark, "/root/testdata/sf0.001").count() == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()


def test_warc_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], PAGES)
    assert {r.page_id: r.refers_to for r in warc.dedupe(pages, min_bytes=3).collect()} == {1: None, 2: None, 3: None, 4: 3}
    assert warc.captures(pages.limit(0)).count() == 0


def test_warc_records_without_response(spark):
    fields = "type string, record_id string, concurrent_to string, page_id long, uri string, refers_to long, payload_bytes long, payload_digest string, payload binary"
    rows = [("request", "q1", "gone", 1, None, None, None, None, None), ("metadata", "m1", "r1", 2, None, None, 5, "d", None),
            ("metadata", "m2", "r1", 2, None, None, 5, "d", None), ("response", "r1", None, 2, None, None, 5, "d", None)]
    got = {r.capture_id: r for r in warc.assemble(spark.createDataFrame(rows, fields)).collect()}
    assert got["gone"].response is None and len(got["gone"].requests) == 1
    assert len(got["r1"].metadata) == 2 and got["r1"].requests is None


CHANGES = "op string, source string, lang string, version string, n_tokens long, old_tokens long"


def amounts(rollup):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_rollup_batches_are_idempotent_and_fold(spark, tmp_path):
    first = spark.createDataFrame([("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None), ("insert", None, None, "v1", None, None)], CHANGES)
    second = spark.createDataFrame([("revise", "a", "en", "v1", 7, 10), ("delete", "a", "en", "v1", 5, None), ("insert", "b", "de", "v2", 1, None),
                                    ("unknown", "b", "de", "v2", 100, None)], CHANGES).withColumn("docs", F.lit(9))
    third = spark.createDataFrame([("delete", "b", "de", "v2", 1, None)], CHANGES)
    rollup = token_rollup.Rollup(spark, str(tmp_path / "store"))
    assert amounts(rollup) == {}
    rollup.commit(2, third)  # out of order
    rollup.commit(0, first)
    rollup.commit(0, first)
    rollup.commit(1, second)
    expected = {("a", "en", "v1"): (1, 7), (None, None, "v1"): (1, 0)}
    assert amounts(rollup) == expected
    rollup.compact(1)
    rollup.compact(1)
    rollup.commit(1, second)  # a late replay
    again = token_rollup.Rollup(spark, str(tmp_path / "store"))
    assert amounts(rollup) == expected == amounts(again)
    again.commit(3, third.limit(0))
    assert amounts(again) == expected


def test_token_patterns(spark):
    frame = spark.createDataFrame([("a b\tc d",), ("x-y é1 漢😀!",), ("",), (None,)], "text string")
    got = [tuple(r) for r in frame.select(*[token_rollup.n_tokens(F.col("text"), p) for p in token_rollup.VERSIONS.values()]).collect()]
    assert got == [(3, 3), (3, 4), (0, 0), (0, 0)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def kept_lines(rows, min_chars=20, distance=6, percent=80):
    """Brute force over all pairs of distinct normalised lines."""
    texts = {line for _, t in rows if t is not None for line in t.split("\n")}
    normal = {t: line_dedup.normalised(t.encode()).decode() for t in texts}
    lines = sorted({n for n in normal.values() if n})
    codes = {n: [int(x) for x in line_dedup.simhashes([n])[:, 0]] for n in lines if len(n) >= min_chars}
    root = {n: n for n in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in codes:
        for b in codes:
            if a < b and any((x ^ y).bit_count() <= distance for x, y in zip(codes[a], codes[b])):
                if levenshtein(a, b) <= (100 - percent) * max(len(a), len(b)) // 100:
                    root[find(a)] = find(b)
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[doc_id] = (None, 0, 0)
            continue
        kept = []
        own = text.split("\n")
        for line in own:
            n = normal[line]
            if n:
                if find(n) in seen:
                    continue
                seen.add(find(n))
            kept.append(line)
        out[doc_id] = ("\n".join(kept), len(own), len(own) - len(kept))
    return out


@pytest.mark.parametrize("distance", [6, 2])
def test_line_dedup(spark, distance):
    rows = corpus(seed=6, n=30)
    long = " ".join(f"word{k}" for k in range(60))
    rows += [(500 + k, long.replace(f"word{k} ", "other ", 1) + "\nshort\n" + long.upper()) for k in range(8)]
    docs = documents(spark, rows).withColumns({c: F.lit("x") for c in ("line", "body", "pos", "n", "doc", "version", "row", "parts", "whole")})
    got = line_dedup.dedup_lines(docs, distance=distance)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in got.collect()} == kept_lines(rows, distance=distance)


def test_line_dedup_ids_and_empty_table(spark):
    line = "the very same line in every row of it"
    got = line_dedup.dedup_lines(documents(spark, [(None, line), (4, line + "\n" + line), (4, line + "\n" + line), (9, line)])).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got) == [(False, 4, line), (False, 4, line), (False, 9, ""), (True, None, "")]
    assert line_dedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline
    from tests.llm.test_text_operators import contaminated, jaccard

    rows = corpus(seed=8)
    base = [f"w{k}" for k in range(100)]
    rows += [(400 + k, " ".join(base[:50] + [f"new{k}"] + base[50:])) for k in range(3)]
    bench = [(1, rows[12][1]), (2, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    sf = str(tmp_path)
    for number, name in enumerate(names):
        before = {r.doc_id: r.text for r in docs.collect()}
        stages[name](spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = {r.doc_id: r for r in docs.collect()}
        if number < 4:
            assert docs.columns == corpus_pipeline.COLUMNS
        if name == "language_id":
            assert set(after) == {d for d, t in before.items() if any(c.isalpha() for c in t or "")}
        elif name == "line_dedup":
            want = kept_lines(sorted(before.items()))
            assert {d: r.text for d, r in after.items()} == {d: t for d, (t, n, gone) in want.items() if gone < n or not gone}
        elif name == "jaccard_join":
            assert set(after) == {d for d, (_, c) in jaccard(sorted(before.items()), 5, 80).items() if c == d}
        elif name == "decontaminate":
            assert set(after) == {d for d, v in contaminated(sorted(before.items()), bench).items() if not v[4]}
        else:
            assert set(after) == set(before)
    for name in names:
        assert stages[name](spark, spark.createDataFrame([], DOCS), sf).count() == 0


def test_all_queries_are_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
