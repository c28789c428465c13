"""Near duplicates by a grouped prefix join on word shingles.

Documents with the same shingle set form a class. Classes are reduced to a prefix of their
shingles in one global order, long enough that any two classes similar enough share a prefix
shingle. Classes with the same prefix and size collapse into one group; groups, not documents,
go through the inverted list of prefix shingles; pairs of groups that pass the size filter
are expanded and their members verified on whole shingle sets.

The order puts shingles that many documents hold last, by counts of a sketch of fixed size, so
that a common passage rarely reaches a prefix. Any order is right; this one keeps lists short.

Only connected components are asked for, so no list is turned into all its pairs: first each
member is verified against its group's first member and each group against the first group it
shares a shingle with. What is then connected needs no further pair; only pairs of a list that
lie in different components are verified, and all of those are, so no link between different
texts that matters for a component is lost.

Defined cases: a null, empty or blank text has no shingles and links with nothing. A null
``doc_id`` cannot be named: its component is null and it links nothing. Rows sharing a ``doc_id``
are one document that links by any of its texts. Columns other than ``doc_id`` and ``text`` are
ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.llm.links import bodies_of, link_groups, unpack, with_bodies
from skillgauge.sources.stores import stage

_CELL_BITS = 22
_SHARD_BITS = 18
_FLUSH = 1 << 21


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a text of fewer words is one shingle."""
    flat, begins = W.hash_words(texts, W.SPACED_LOWER)
    windows = W.hash_windows(flat, size)
    out = []
    for a, b in zip(begins, begins[1:]):
        if b - a >= size:
            own = np.sort(windows[a : b - size + 1])
            new = np.ones(len(own), dtype=bool)
            new[1:] = own[1:] != own[:-1]
            out.append(own[new])
        else:
            out.append(W.hash_windows(flat[a:b], int(b - a)) if b > a else np.empty(0, dtype=np.uint64))
    return out


def _cell(shingles: np.ndarray) -> np.ndarray:
    return (W.mix(shingles, 7) >> np.uint64(64 - _CELL_BITS)).astype(np.int64)


def _count_cells(size: int):
    def run(batches):
        totals, pending, held = np.zeros(1 << _CELL_BITS, dtype=np.int64), [], 0
        for batch in batches:
            pending += shingle_sets(W.bodies(batch), size)
            held = sum(map(len, pending))
            if held >= _FLUSH:
                totals += np.bincount(_cell(np.concatenate(pending)), minlength=len(totals))
                pending = []
        if pending:
            totals += np.bincount(_cell(np.concatenate(pending)), minlength=len(totals))
        if totals.any():
            parts = totals.reshape(-1, 1 << _SHARD_BITS)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(range(len(parts)), pa.int32()),
                "counts": [zstandard.compress(np.ascontiguousarray(p.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1) for p in parts],
            })

    return run


def _add_cells(frames):
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for shard, blob in zip(frame["shard"], frame["counts"]):
            planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(8, -1)
            sums[shard] = sums.get(shard, 0) + np.ascontiguousarray(planes.T).view("<i8").ravel()
    for shard, counts in sums.items():
        level = np.minimum(np.floor(2 * np.log2(counts + 1.0)), 255).astype(np.uint8)
        yield pd.DataFrame({"shard": [shard], "level": [level.tobytes()]})


def frequency_levels(body: DataFrame, size: int) -> bytes:
    """One byte per cell: about twice the logarithm of how many documents hold the cell's shingles. 4 MB at any corpus size."""
    levels = bytearray(1 << _CELL_BITS)
    counted = body.mapInArrow(W.frugal(_count_cells(size)), "shard int, counts binary").repartition("shard")
    for row in counted.mapInPandas(_add_cells, "shard int, level binary").collect():
        levels[row["shard"] << _SHARD_BITS : (row["shard"] + 1) << _SHARD_BITS] = row["level"]
    return bytes(levels)


def _needed(n: int, percent: int) -> int:
    """Least overlap of a set of ``n`` with any set similar enough."""
    return -(-percent * n // 100)


def _signatures(size: int, percent: int, levels):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        level = np.frombuffer(levels.value, dtype=np.uint8)
        for batch in batches:
            rows = []
            for doc_id, own in zip(batch.column("doc_id").to_pylist(), shingle_sets(W.bodies(batch), size)):
                n = len(own)
                s1, s2 = (int(W.mix(own, seed).sum(dtype=np.uint64).astype(np.int64)) for seed in (11, 13))
                keys = (level[_cell(own)].astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8))
                p = n - _needed(n, percent) + 1 if n else 0
                first = np.sort(np.partition(keys, p - 1)[:p] if 0 < p < n else keys)
                rows.append((doc_id, n, s1, s2, first.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def _verify(size: int, percent: int):
    def run(batches):
        for batch in batches:
            left, right = shingle_sets(unpack(batch, "body_a"), size), shingle_sets(unpack(batch, "body_b"), size)
            keep = []
            for x, y in zip(left, right):
                both = np.sort(np.concatenate([x, y]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return run


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document row. Two documents link when the
    Jaccard similarity of their sets of ``size``-word shingles is at least ``percent`` hundredths."""
    spark = docs.sparkSession
    W.small_batches(spark)
    body = W.texts_of(docs)
    levels = spark.sparkContext.broadcast(frequency_levels(body, size))
    signed = stage(body.mapInArrow(W.frugal(_signatures(size, percent, levels)), "doc_id long, n long, s1 long, s2 long, prefix array<long>"), "signatures")
    classes = stage(
        signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("s1", "s2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix"))
        .withColumn("key", F.xxhash64("prefix", "n")), "classes")
    heads = stage(classes.groupBy("key", "n").agg(F.min("rep").alias("head"), F.first("prefix").alias("prefix")), "heads")
    members = classes.select("rep", "key", "n").join(heads.select("key", "n", "head"), ["key", "n"]).select(F.col("rep").alias("node"), "head")
    members = stage(members, "members")
    # Most shingles of a prefix are in one group only and find nothing; the later steps never see them.
    listed = heads.select("head", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = listed.groupBy("token").agg(F.min("head").alias("low"), F.max("head").alias("high")).where("low < high").select("token")
    tokens = stage(listed.join(shared, "token"), "prefixes")
    banded = tokens.withColumn("band", F.floor(F.log("n") / float(-np.log(percent / 100))))
    firsts = banded.groupBy("token", "band").agg(F.min("head").alias("b"), F.count(F.lit(1)).alias("k")).where("k > 1")
    near = banded.join(firsts, ["token", "band"]).where(F.col("head") != F.col("b")).groupBy(F.col("head").alias("a")).agg(F.min("b").alias("b"))

    def fits(x: DataFrame, y: DataFrame) -> Column:
        most = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))  # overlap, if this is the first shared shingle
        sizes = 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
        return sizes & ((100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n")))

    find = bodies_of(body.withColumnRenamed("doc_id", "id"))
    verify = lambda pairs, name: stage(
        with_bodies(find, pairs, name).mapInArrow(W.frugal(_verify(size, percent)), "a long, b long"), f"{name}-links")
    final = link_groups(members, tokens, near, fits, verify)

    named = classes.select("s1", "s2", "n", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "s1", "s2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = signed.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2", "n"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_first(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The rows of ``docs``, all columns as they are, less the documents linked to one of a smaller id.
    Rows sharing a ``doc_id`` share the decision; rows without one stay."""
    found = jaccard_components(docs, size, percent)
    later = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_later")).distinct()
    return docs.join(later, docs["doc_id"] == later["_later"], "left_anti")


def op4_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
