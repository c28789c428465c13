"""Benchmark decontamination by winnowing.

Of every ``w`` consecutive k-grams the one with the least hash is a fingerprint, so two texts that
share ``k + w - 1`` consecutive words share a fingerprint there. With ``k + w - 1`` equal to the
window, every occurrence of a benchmark window in a document is found: fingerprints of
documents and items are joined, each match carries the word hashes around it, and the match is
extended word by word to both sides. Items shorter than a window are one window; they are looked
up whole, with a fingerprint at each position (w = 1).

Before the join a bitmap of the items' fingerprints (fixed size, 2 MB) drops document
fingerprints that no item has; it saturates with a growing benchmark and loses none.

Defined cases: null or wordless texts have no words, no hits and are not contaminated. Items
that are null or wordless have no windows. A null ``item_id`` marks words as hit but is not in the
list of items. Rows that repeat a ``doc_id`` are judged one by one. Repeated items count once per
``item_id``. Columns other than ids and texts are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.sources.stores import stage

_BITS = 24
_GRAM = 5


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the least hash of every ``width`` consecutive ones, the last of equal ones."""
    n = len(hashes)
    if n <= width:
        return np.array([n - 1 - int(np.argmin(hashes[::-1]))]) if n else np.empty(0, dtype=np.int64)
    # Least of a window = least of the end of one block and the start of the next.
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = hashes
    grid = padded.reshape(blocks, width)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(tail[: n - width + 1], head[width - 1 : n])
    chosen = np.zeros(n, dtype=bool)
    for k in range(width):
        chosen[k : n - width + 1 + k] |= hashes[k : n - width + 1 + k] == least
    return np.flatnonzero(chosen)


def _marks(flat: np.ndarray, begins: np.ndarray, window: int, short: list[int], items: bool):
    """(whole, run length, hashes, positions): winnowed k-grams of the long texts, then whole short runs.

    An item of fewer words than a window is one whole run; a document is looked up at every position."""
    gram, lengths = min(_GRAM, window), np.diff(begins)
    grams = W.hash_windows(flat, gram)
    found = [a + winnow(grams[a : a + n - gram + 1], window - gram + 1) for a, n in zip(begins, lengths) if n >= window]
    if found:
        at = np.concatenate(found)
        yield False, gram, grams[at], at
    for size in short:
        at = begins[:-1][lengths == size] if items else W.window_starts(begins, size)
        if len(at):
            yield True, size, W.hash_windows(flat, size)[at], at


_SCHEMA = pa.schema([
    ("id", pa.int64()), ("n_words", pa.int64()),
    ("marks", pa.list_(pa.struct([("key", pa.int64()), ("pos", pa.int64()), ("size", pa.int32()), ("near", pa.binary())])))])
_SQL = "id long, n_words long, marks array<struct<key:bigint,pos:bigint,size:int,near:binary>>"


def _near(flat: np.ndarray, begin: int, end: int, at: int, size: int, reach: int) -> bytes:
    """Hashes of the words of a run and of ``reach`` words to both sides, 0 beyond the text."""
    out = np.zeros(size + 2 * reach, dtype=np.uint64)
    low, high = max(begin, at - reach), min(end, at + size + reach)
    out[low - at + reach : high - at + reach] = flat[low:high]
    return out.tobytes()


def _fingerprints(window: int, short: list[int], bitmap=None):
    """Fingerprints per text; of documents (with ``bitmap``) only those that an item may have."""
    def run(batches):
        known = np.frombuffer(bitmap.value, dtype=np.uint64) if bitmap is not None else None
        for batch in batches:
            flat, begins = W.hash_words(W.bodies(batch), W.ALNUM_LOWER)
            rows = [[] for _ in range(len(begins) - 1)]
            for whole, size, hashes, at in _marks(flat, begins, window, short, items=bitmap is None):
                # Runs of different kinds never meet.
                keys = W.mix(hashes, 1000 + size if whole else 3)
                if known is not None:
                    cell = keys >> np.uint64(64 - _BITS)
                    keep = (known[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1) == 1
                    keys, at = keys[keep], at[keep]
                owner = np.searchsorted(begins, at, side="right") - 1
                reach = 0 if whole else window - size
                for key, pos, row in zip(keys.view(np.int64).tolist(), at.tolist(), owner.tolist()):
                    begin, end = int(begins[row]), int(begins[row + 1])
                    rows[row].append({"key": key, "pos": pos - begin, "size": size, "near": _near(flat, begin, end, pos, size, reach)})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(np.diff(begins), pa.int64()), pa.array(rows, _SCHEMA.field("marks").type)], schema=_SCHEMA)

    return run


def _extend(window: int):
    """Extend each match to both sides; runs of a whole window or a whole short item are hits."""
    schema = pa.schema([("uid", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("items", pa.list_(pa.string()))])

    def run(batches):
        for batch in batches:
            rows = []
            for uid, pos, size, mine, other, items in zip(*(batch.column(c).to_pylist() for c in ("uid", "pos", "size", "near", "other", "items"))):
                x, y = np.frombuffer(mine, dtype=np.uint64), np.frombuffer(other, dtype=np.uint64)
                same = (x == y) & (x != 0)
                reach = (len(same) - size) // 2
                if not same[reach : reach + size].all():
                    continue
                left = int(np.argmin(np.append(same[:reach][::-1], False)))
                right = int(np.argmin(np.append(same[reach + size :], False)))
                if not reach or left + size + right >= window:
                    rows.append((uid, pos - left, pos + size + right, items))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows) if rows else [()] * 4, schema.types)], schema=schema)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit (words inside an occurrence of a benchmark window),
    n_items, items_sha256 (of the sorted item ids), items, contaminated (at least a twentieth of the
    words hit)."""
    spark = docs.sparkSession
    W.small_batches(spark)
    texts = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").cast("binary").alias("body"))
    short = list(range(1, window))
    items = stage(texts.mapInArrow(_fingerprints(window, short), _SQL), "benchmark-marks")
    short = sorted(r[0] for r in items.where(F.col("n_words").between(1, window - 1)).select("n_words").distinct().collect())
    marks = items.select(F.col("id").cast("string").alias("item"), F.explode("marks").alias("m")).select("item", "m.key", "m.near")
    wanted = marks.groupBy("key", F.col("near").alias("other")).agg(F.collect_set("item").alias("items"))

    cell = marks.select(F.shiftrightunsigned("key", 64 - _BITS).alias("cell"))
    words = cell.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 as int))")).alias("bits"))
    bitmap = np.zeros(1 << (_BITS - 6), dtype=np.int64)
    for at, bits in words.collect():
        bitmap[at] = bits
    known = spark.sparkContext.broadcast(bitmap.tobytes())

    body = W.texts_of(docs).withColumnRenamed("doc_id", "id")
    marked = stage(
        body.mapInArrow(W.frugal(_fingerprints(window, short, known)), _SQL).withColumn("uid", F.monotonically_increasing_id()), "document-marks")
    found = marked.select("uid", F.explode("marks").alias("m")).select("uid", "m.key", "m.pos", "m.size", "m.near")
    hits = stage(
        found.join(wanted, "key").select("uid", "pos", "size", "near", "other", "items")
        .mapInArrow(_extend(window), "uid long, low long, high long, items array<string>"), "hits")
    before = F.max("high").over(Window.partitionBy("uid").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    covered = hits.select("uid", "low", "high").distinct().withColumn("new", F.greatest(
        F.lit(0), F.col("high") - F.greatest("low", F.coalesce(before, F.lit(0))))).groupBy("uid").agg(F.sum("new").alias("n_hit"))
    named = hits.select("uid", F.explode("items").alias("item")).groupBy("uid").agg(F.sort_array(F.collect_set("item")).alias("items"))
    out = marked.select("uid", F.col("id").alias("doc_id"), "n_words").join(covered, "uid", "left").join(named, "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", listed), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), listed.alias("items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose document is not contaminated. Rows sharing a
    ``doc_id`` share the decision; rows without one cannot be named and stay."""
    bad = contamination(docs, benchmark, window).where("contaminated").select(F.col("doc_id").alias("_gone")).where("_gone is not null").distinct()
    return docs.join(bad, docs["doc_id"] == bad["_gone"], "left_anti")


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, benchmark).drop("items")
