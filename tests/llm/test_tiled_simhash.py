"""SimHash groups of tile comparisons against all pairs by brute force."""

import random

import numpy as np
import pytest
import xxhash

from skillgauge.llm import tiled_simhash as S
from tests.llm.cases import corpus, documents, lowered


def fingerprint(text, size=3):
    words = lowered(text)
    if not words:
        return 0
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, distance=3):
    """Component of each position by flooding over all pairs."""
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = grouped(prints)
    first = {}
    for (doc, _), own in zip(rows, label):
        if doc is not None:
            first[own] = min(doc, first.get(own, doc))
    return sorted(((d, f"{p:016x}", first.get(own)) for (d, _), p, own in zip(rows, prints, label)), key=str)


def found(spark, rows, tmp_path):
    folder = str(tmp_path / "t")
    documents(spark, rows).withColumnsRenamed({"lang": "sketch", "source": "cell"}).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return sorted(map(tuple, S.op12_tiled_simhash(spark, folder).collect()), key=str)


def near_copies(seed, n, base):
    rng = random.Random(seed)
    own = base.split()
    for _ in range(n):
        copy = list(own)
        copy[rng.randrange(len(copy))] = f"w{rng.randrange(50)}"
        yield " ".join(copy)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(spark, tmp_path, seed):
    rows = corpus(seed)
    long = " ".join(f"word{(k * k) % 97}" for k in range(300))
    rows += [(1000 + k, t) for k, t in enumerate([long, *near_copies(seed, 40, long)])]
    rows += [(None, long), (None, "only here and without an id"), (rows[0][0], rows[0][1]), (rows[3][0], "another text with that id")]
    got = found(spark, rows, tmp_path)
    assert got == expected(rows)
    sizes = [c for _, _, c in got]
    assert max(map(sizes.count, sizes)) > 20


def test_spark_hashes_alike(spark):
    texts = ["", "one", "two words", "ünï cödé 漢", "x" * 1000]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) h").collect()
    assert all(r.h & (2**64 - 1) == xxhash.xxh64_intdigest(r.t.encode(), 42) for r in rows)


def test_long_texts_are_whole():
    rng = random.Random(3)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(2 * S._FLUSH + 77))
    assert S.simhashes([b"a b c", text.encode(), b"", b"D e"]).tolist() == [fingerprint("a b c"), fingerprint(text), 0, fingerprint("d e")]


def test_empty_table(spark, tmp_path):
    assert found(spark, [], tmp_path) == []


def test_all_links_of_tiles_count(spark):
    """Random sketches with planted neighbours at exact distances, in small tiles: the components of all pairs."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, d, replace=False)) for b in base for d in (2, 3, 4)]
    prints = sorted({*map(int, base), *near})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "sketch long")
    links = S.sketch_links(frame, tile=5).collect()
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 64 for a, b in links)
    place = {x: i for i, x in enumerate(signed)}
    groups = S.Groups(len(signed))
    groups.merge(np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]))
    assert groups.label.tolist() == grouped(prints)


def test_dense_tiles_send_chains():
    """A tile pair in which all are near: fewer links than fingerprints, and one group."""
    some = np.array(sorted({(1 << i) | (1 << j) for i in range(30) for j in range(i)}), dtype=np.uint64)
    a, b = S.tile_links(some[:200], some[200:], False, 4)
    assert len(a) == len(some) - 1 and len({*a.tolist(), *b.tolist()}) == len(some)
    a, b = S.tile_links(some, some, True, 4)
    assert len(a) == len(some) - 1


def test_keep_first(spark):
    rows = [(3, "same text of a few words"), (1, "same text of a few words"), (None, "same text of a few words"), (2, "quite another text stands here now")]
    assert sorted(r.doc_id or 0 for r in S.keep_first(documents(spark, rows)).collect()) == [0, 1, 2]
