"""Periodic runs and collapsed texts against brute force over every lag."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skillgauge.llm import periodic_runs as P
from tests.llm.cases import corpus, documents, words


def runs_of(w, least=24, repeats=3):
    out = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, repeats * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in out.items())


def planted(doc, w):
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(w)
    if doc is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def row(doc, text):
    w = planted(doc, words(text))
    runs = runs_of(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return doc, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def repetitive(rng, n):
    letters = rng.choice([1, 2, 3, 60])
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        p, s = rng.randint(1, max(1, n // 3)), rng.randrange(n)
        for i in range(s + p, min(n, s + p * rng.randint(2, 6) + rng.randrange(p))):
            w[i] = w[i - p]
    return w


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(7)
    rows = corpus(3) + [(500 + k, " ".join(f"w{x}" for x in repetitive(rng, rng.choice([30, 80, 300])))) for k in range(150)]
    rows += [(900, "a " * 23), (901, "a\t" * 24), (902, "a b c d e f g h " * 3), (903, "a b c d e f g h i " * 3), (904, "漢 é " * 40)]
    rows += [(None, "x y " * 30), rows[70], rows[70], (700, "another text with an id that is taken " * 9)]
    folder = str(tmp_path / "t")
    documents(spark, rows).withColumnsRenamed({"lang": "row", "source": "Runs"}).write.parquet(f"{folder}/documents.parquet")
    got = sorted(map(tuple, P.op11_periodic_runs(spark, folder).collect()), key=str)
    assert got == sorted((row(d, t) for d, t in rows), key=str)
    assert sum(r[1] for r in got) > 80


def test_other_columns_stay(spark):
    rows = documents(spark, [(1, "a b " * 20), (2, None), (3, "")]).withColumnsRenamed({"lang": "row", "source": "RUNS", "n_chars": "body"})
    got = {r["doc_id"]: r for r in P.collapse_runs(rows).collect()}
    assert list(got[1].asDict()) == ["doc_id", "text", "row", "body", "n_words", "runs"]
    assert (got[1].text, got[1].n_words, [tuple(r) for r in got[1].runs], got[1].row) == ("a b", 40, [(0, 40, 2)], "en")
    assert (got[2].text, got[2].n_words, got[3].text, got[3].runs) == (None, 0, "", [])


def test_empty_table(spark):
    assert P.collapse_runs(documents(spark, [])).collect() == []


@pytest.mark.parametrize("least,repeats", [(24, 3), (3, 3), (7, 3), (12, 5), (100, 4)])
def test_other_bounds(least, repeats):
    rng = random.Random(least)
    texts = [repetitive(rng, rng.choice([1, 5, 40, 200])) for _ in range(200)] + [[]]
    got = P.find_runs([np.array(t, dtype=np.int64) for t in texts], least, repeats)
    assert [[tuple(map(int, r)) for r in own] for own in got] == [runs_of(t, least, repeats) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=90), max_size=4))
def test_any_texts(texts):
    got = P.find_runs([np.array(t, dtype=np.int64) for t in texts])
    assert [[tuple(map(int, r)) for r in own] for own in got] == [runs_of(t) for t in texts]


def test_very_long_text():
    """Half a million words, all alike but for one in the middle: two runs, no pair list of quadratic length."""
    long = np.zeros(500_000, dtype=np.int64)
    long[250_000] = 1
    assert [tuple(map(int, r)) for r in P.find_runs([long])[0]] == [(0, 250_000, 1), (250_001, 249_999, 1)]


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        P.find_runs([], repeats=2)
