"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

The fingerprint of a text has a bit for each of the 64 of XXH64 (seed 42): 1 if set in over half of the
hashes of its word shingles. Documents whose fingerprints differ in at most ``DISTANCE`` bits link.

Equal fingerprints are taken together first. A fingerprint's four quarters of 16 bits have four population
counts; the counts of two fingerprints differ, summed over the quarters, by no more than their bits
do. So tiles hold fingerprints of equal counts, and a pair of tiles is skipped when its counts differ
by more than the radius: all other pairs of tiles, and nothing else, are compared whole, by exclusive-or and bit
counts over blocks of rows. For random fingerprints that is one pair in about twenty. Which tiles meet is
settled on their counts alone; only then are the tiles joined to the pairs, so what one task holds is
two tiles. The work still grows with the square of the number of distinct fingerprints, as the method has it.

Of the links of a pair of tiles, a chain through each connected group is sent on, never all of them.

Defined cases: null, empty and blank texts have the fingerprint zero, which links like any other. Fewer words
than a shingle make one of all. Rows with a null ``doc_id`` take part; a group of only such rows has a
null component_id. Repeated rows are repeated in the result, and rows that share a ``doc_id`` keep their own
fingerprints. Columns other than ``doc_id`` and ``text``, whatever their names, are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.llm.components import components
from skillgauge.sources.stores import stage

SHINGLE, DISTANCE, TILE = 3, 3, 4096
_SEED = 42
_QUARTERS, _SHIFT = 4, 8  # a count takes a byte of a cell, with room for the neighbours' offsets
_FLUSH = 1 << 15


def _shingle_hashes(text: bytes, size: int):
    """How many shingles a text has, and their hashes one after the other."""
    words = text.lower().split()
    if not words:
        return 0, iter(())
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    hashed = xxhash.xxh64_intdigest
    return n, (hashed(joined[a:b], _SEED) for a, b in zip(starts[:n].tolist(), ends[len(words) - n :].tolist()))


def simhashes(texts: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text."""
    counts, totals = np.zeros((len(texts), 64), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    pending, owners = [], []  # hashes and (text, how many of them), a long text in several parts

    def flush():
        bits = np.unpackbits(np.array(pending, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.concatenate([[0], np.cumsum([k for _, k in owners])[:-1]])
        np.add.at(counts, [t for t, _ in owners], np.add.reduceat(bits, begins, axis=0, dtype=np.int32))
        pending.clear()
        owners.clear()

    for t, text in enumerate(texts):
        totals[t], hashes = _shingle_hashes(text, size)
        left = int(totals[t])
        while left:
            part = min(left, _FLUSH)
            pending.extend(itertools.islice(hashes, part))
            owners.append((t, part))
            left -= part
            if len(pending) >= _FLUSH:
                flush()
    if pending:
        flush()
    ones = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()


def _fingerprint(size: int):
    def run(batches):
        for batch in batches:
            found = simhashes(W.bodies(batch), size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64), pa.int64())], names=["doc_id", "sketch"])

    return run


def _cell(sketch: Column) -> Column:
    """The population counts of the quarters, each in a byte of its own; 8 is added to leave room below."""
    cell = F.lit(0).cast("long")
    for k in range(_QUARTERS):
        count = F.bit_count(F.shiftrightunsigned(sketch, 16 * k).bitwiseAND(0xFFFF)).cast("long") + 8
        cell = cell + F.shiftleft(count, _SHIFT * k)
    return cell


def _offsets(distance: int) -> list[int]:
    """From a cell to those within the distance, one of every two opposite ways, itself included."""
    ways = [w for w in itertools.product(range(-distance, distance + 1), repeat=_QUARTERS) if sum(map(abs, w)) <= distance]
    return [sum(x << (_SHIFT * k) for k, x in enumerate(w)) for w in ways if w >= (0,) * _QUARTERS]


class Groups:
    """Connected groups of 0 .. n-1, merged by arrays of pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            root = np.arange(len(self.label))
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while (root[root] != root).any():
                root = root[root]
            self.label = root[self.label]

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours in each group's ascending members."""
        order = np.argsort(self.label, kind="stable")
        same = self.label[order[1:]] == self.label[order[:-1]]
        return order[:-1][same], order[1:][same]


def tile_links(one: np.ndarray, two: np.ndarray, same: bool, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what lies within the distance in two tiles (or in one, if ``same``)."""
    groups, shift = Groups(len(one) + (0 if same else len(two))), 0 if same else len(one)
    at, rows = 0, 1
    while at < len(one):
        label, to = groups.label, min(at + rows, len(one))
        near = np.bitwise_count(one[at:to, None] ^ two[None, :]) <= distance
        near &= label[at:to, None] != label[None, shift : shift + len(two)]  # what is connected needs no pair
        a, b = np.nonzero(near)
        groups.merge(a + at, b + shift)
        at, rows = to, min(256, 2 * rows)
    both = one if same else np.concatenate([one, two])
    a, b = groups.chains()
    return both[a], both[b]


def _pack(batches):
    """Tiles as sorted bytes."""
    for batch in batches:
        packed = [np.sort(np.array(x, dtype=np.int64)).tobytes() for x in batch.column("sketches").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("cell"), batch.column("part"), pa.array(packed, pa.binary())], names=["cell", "part", "tile"])


def _compare(distance: int):
    def run(batches):
        for batch in batches:
            found = []
            for one, two, same in zip(*(batch.column(c).to_pylist() for c in ("tile_a", "tile_b", "same"))):
                a, b = tile_links(np.frombuffer(one, dtype=np.uint64), np.frombuffer(two, dtype=np.uint64), same, distance)
                if len(a):
                    found.append((a, b))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.uint64),) * 2
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def sketch_links(sketches: DataFrame, distance: int = DISTANCE, tile: int = TILE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column ``sketch``) within the distance that connect all that lie within it."""
    placed = sketches.select("sketch", _cell(F.col("sketch")).alias("cell"))
    parts = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("parts"))
    parts = stage(parts, "cells")  # a row for each of at most 17**4 counts
    dealt = placed.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("sketch"), F.col("parts")).cast("int"))
    tiles = dealt.groupBy("cell", "part").agg(F.collect_list("sketch").alias("sketches"))
    tiles = stage(tiles.mapInArrow(W.frugal(_pack), "cell long, part int, tile binary"), "tiles")
    keys = tiles.select("cell", "part")
    ways = F.array(*[F.lit(x).cast("long") for x in _offsets(distance)])
    one = keys.select(F.col("cell").alias("cell_a"), F.col("part").alias("part_a"), F.explode(F.transform(ways, lambda d: F.col("cell") + d)).alias("cell_b"))
    pairs = one.join(keys.select(F.col("cell").alias("cell_b"), F.col("part").alias("part_b")), "cell_b")
    pairs = pairs.where("cell_a != cell_b or part_a <= part_b")
    named = lambda s: tiles.select(*[F.col(c).alias(f"{c}_{s}") for c in tiles.columns]).hint("merge")
    both = pairs.join(named("a"), ["cell_a", "part_a"]).join(named("b"), ["cell_b", "part_b"])
    both = both.select("tile_a", "tile_b", F.expr("cell_a = cell_b and part_a = part_b").alias("same"))
    return both.mapInArrow(W.frugal(_compare(distance)), "a long, b long").distinct()


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, sketch) of every row; a sketch is the fingerprint's 64 bits as a long."""
    W.small_batches(docs.sparkSession)
    return W.texts_of(docs).mapInArrow(W.frugal(_fingerprint(size)), "doc_id long, sketch long")


def near_groups(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, sketch, component_id) of every row; component_id is the smallest doc_id that links lead to."""
    printed = stage(fingerprints(docs, size), "fingerprints")
    classes = stage(printed.groupBy("sketch").agg(F.min("doc_id").alias("least")), "sketches")
    labels = components(sketch_links(classes, distance), "a", "b").toDF("sketch", "label")
    labelled = stage(labels.join(classes, "sketch"), "labelled-sketches")
    named = labelled.groupBy("label").agg(F.min("least").alias("first"))
    linked = labelled.join(named, "label").select("sketch", "first")
    of = classes.join(linked, "sketch", "left").select("sketch", F.when(F.col("first").isNull(), F.col("least")).otherwise(F.col("first")).alias("component_id"))
    return printed.join(of, "sketch").select("doc_id", "sketch", "component_id")


def keep_first(docs: DataFrame, size: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Of each group of near duplicates the rows with the smallest doc_id; rows without one stay."""
    gone = near_groups(docs, size, distance).where("doc_id > component_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")


def op12_tiled_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("sketch"), 16, "0")).alias("fingerprint"), "component_id")
