"""Substring dedup with a count-min prefilter.

1. Every partition sketches the windows of its texts: two rows of cells, each cell saying "seen
   once" or "seen more often". The partition sketches are shuffled by cell range and merged by
   saturating addition. A cell never underestimates, so a window that occurs twice is never lost.
2. A second pass over the texts keeps only windows estimated repeated and groups exactly those by
   a 96-bit fingerprint of the word sequence. Every task first combines what it holds of a window
   into one entry per document bucket, so a passage in a third of all documents is one entry per
   bucket and not one per document. The smallest document of each window goes back to the buckets
   that hold a larger one.
3. Documents meet the answers of their bucket and drop the covered words.

The sketch is the only thing broadcast; ``max_cells`` bounds it (two bits per column of cells,
128 MB at the default). A corpus with more windows than cells fills it: more unique windows then pass the
prefilter and the exact second pass does more work, with the same result.

Defined cases: null and empty texts have no words (0, 0, hash of the empty text). A text shorter
than a window keeps everything. A null ``doc_id`` counts as larger than every id. Rows that share
a ``doc_id`` are the same document as regards order: neither removes words of the other. Columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.sources.stores import stage

_NO_ID = np.iinfo(np.int64).max
_SHARD_CELLS = 1 << 20
_FLUSH = 1 << 20
_WORDS_PER_BUCKET = 100_000
_WINDOWS_PER_SHARD = 500_000
_DEPTH = 2

SKETCH = "line int, shard int, cells binary, many binary, n long"
ENTRIES = "shard int, h1 binary, h2 binary, bucket binary, low binary, span binary"
ANSWERS = "bucket int, h1 binary, h2 binary, low binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cells(windows: np.ndarray, line: int, bits: int) -> np.ndarray:
    return (W.mix(windows, line + 1) >> np.uint64(64 - bits)).astype(np.uint32)


def _pack(values: np.ndarray) -> bytes:
    """Sorted numbers as compressed steps, low bytes first."""
    steps = np.diff(values, prepend=np.uint32(0)).astype("<u4")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), dtype=np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _sketch(size: int, bits: int):
    def flush(pending):
        windows, out = np.concatenate(pending), {k: [] for k in ("line", "shard", "cells", "many", "n")}
        for line in range(_DEPTH):
            cells = np.sort(_cells(windows, line, bits))
            first = _groups(cells)
            many = np.diff(np.append(first, len(cells))) > 1
            cells = cells[first]
            cuts = _groups(cells >> np.uint32(20))
            for a, b in zip(cuts, np.append(cuts[1:], len(cells))):
                out["line"].append(line)
                out["shard"].append(int(cells[a]) >> 20)
                out["cells"].append(_pack(cells[a:b] & np.uint32(_SHARD_CELLS - 1)))
                out["many"].append(np.packbits(many[a:b]).tobytes())
                out["n"].append(int(b - a))
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([
            ("line", pa.int32()), ("shard", pa.int32()), ("cells", pa.binary()), ("many", pa.binary()), ("n", pa.int64())]))

    def run(batches):
        pending, held = [], 0
        for batch in batches:
            flat, begins = W.hash_words(W.bodies(batch), W.SPACED)
            windows = W.hash_windows(flat, size)[W.window_starts(begins, size)]
            if len(windows):
                pending.append(windows)
                held += len(windows)
            if held >= 2 * _FLUSH:
                yield flush(pending)
                pending, held = [], 0
        if held:
            yield flush(pending)

    return run


def _merge(frames):
    """Streams the partition sketches of some cell ranges; memory follows the ranges, not the partitions."""
    seen: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for frame in frames:
        for line, shard, cells, many, n in frame.itertuples(index=False):
            once, twice = seen.setdefault((line, shard), (np.zeros(_SHARD_CELLS, dtype=bool), np.zeros(_SHARD_CELLS, dtype=bool)))
            at = _unpack(cells, n)
            twice[at] |= once[at] | np.unpackbits(np.frombuffer(many, dtype=np.uint8), count=n).astype(bool)
            once[at] = True
    for (line, shard), (_, twice) in seen.items():
        yield pd.DataFrame({"line": [line], "shard": [shard], "bitmap": [np.packbits(twice).tobytes()]})


def repeated_cells(docs: DataFrame, size: int, bits: int) -> list[bytes]:
    """One bitmap per sketch line: cells that at least two windows fell into. At most 2**bits / 8 bytes each."""
    parts = docs.mapInArrow(W.frugal(_sketch(size, bits)), SKETCH).repartition("line", "shard")
    maps = [bytearray((1 << bits) // 8 or 1) for _ in range(_DEPTH)]
    step = _SHARD_CELLS // 8
    for row in parts.mapInPandas(_merge, "line int, shard int, bitmap binary").toLocalIterator():
        room = len(maps[row["line"]]) - row["shard"] * step
        maps[row["line"]][row["shard"] * step : row["shard"] * step + min(step, room)] = row["bitmap"][:room]
    return [bytes(m) for m in maps]


def _groups(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys in sorted arrays."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _candidates(size: int, bits: int, shard_bits: int, sketch):
    schema = pa.schema([("shard", pa.int32())] + [(n, pa.binary()) for n in ("h1", "h2", "bucket", "low", "span")])

    def flush(pending):
        h1, h2, bucket, doc = (np.concatenate(x) for x in zip(*pending))
        order = np.lexsort((bucket, h2, h1))
        h1, h2, bucket, doc = h1[order], h2[order], bucket[order], doc[order]
        first = _groups(h1, h2, bucket)
        low, high = np.minimum.reduceat(doc, first), np.maximum.reduceat(doc, first)
        h1, h2, bucket = h1[first], h2[first], bucket[first]
        shard = (h1 >> np.uint64(64 - shard_bits)).astype(np.int32) if shard_bits else np.zeros(len(h1), dtype=np.int32)
        cuts = _groups(shard)
        out = {k: [] for k in schema.names}
        for a, b in zip(cuts, np.append(cuts[1:], len(h1))):
            out["shard"].append(int(shard[a]))
            for name, values in (("h1", h1), ("h2", h2), ("bucket", bucket), ("low", low), ("span", high - low)):
                out[name].append(values[a:b].tobytes())
        return pa.RecordBatch.from_pydict(out, schema=schema)

    def run(batches):
        maps = [np.frombuffer(m, dtype=np.uint8) for m in sketch.value]
        pending, held = [], 0
        for batch in batches:
            flat, begins = W.hash_words(W.bodies(batch), W.SPACED)
            starts = W.window_starts(begins, size)
            windows = W.hash_windows(flat, size)[starts]
            keep = np.ones(len(windows), dtype=bool)
            for line, cells in enumerate(maps):
                at = _cells(windows[keep], line, bits)
                keep[keep] = (cells[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            if keep.any():
                rows = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[starts[keep]]
                ids = np.array([_NO_ID if x is None else x for x in batch.column("doc_id").to_pylist()], dtype=np.int64)
                buckets = np.array(batch.column("bucket").to_pylist(), dtype=np.int32)
                second = (W.hash_windows(flat, size, 1)[starts[keep]] >> np.uint64(32)).astype(np.uint32)
                pending.append((windows[keep], second, buckets[rows], ids[rows]))
                held += len(rows)
            if held >= _FLUSH:
                yield flush(pending)
                pending, held = [], 0
        if held:
            yield flush(pending)

    return run


def _joined(frame: pd.DataFrame, **kinds) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(frame[name]), dtype=kind) for name, kind in kinds.items()]


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """For every bucket, the windows that also start in a document smaller than one of the bucket's."""
    h1, h2, bucket, low, span = _joined(frame, h1=np.uint64, h2=np.uint32, bucket=np.int32, low=np.int64, span=np.int64)
    order = np.lexsort((h2, h1))
    h1, h2, bucket, low, span = h1[order], h2[order], bucket[order], low[order], span[order]
    first = _groups(h1, h2)
    least = np.repeat(np.minimum.reduceat(low, first), np.diff(np.append(first, len(h1))))
    hit = np.flatnonzero(low + span > least)
    hit = hit[np.argsort(bucket[hit], kind="stable")]
    h1, h2, bucket, least = h1[hit], h2[hit], bucket[hit], least[hit]
    cuts = _groups(bucket)
    spans = list(zip(cuts, np.append(cuts[1:], len(h1)))) if len(h1) else []
    return pd.DataFrame({
        "bucket": pd.Series([int(bucket[a]) for a, _ in spans], dtype="int32"),
        "h1": [h1[a:b].tobytes() for a, b in spans], "h2": [h2[a:b].tobytes() for a, b in spans],
        "low": [least[a:b].tobytes() for a, b in spans],
    })


def _covered(flat, begins, ids, answers: pd.DataFrame, size: int) -> np.ndarray:
    """Which words lie in a window that also starts in a smaller document."""
    cover = np.zeros(len(flat) + 1, dtype=np.int64)
    starts = W.window_starts(begins, size)
    if len(answers) and len(starts):
        h1, h2, low = _joined(answers, h1=np.uint64, h2=np.uint32, low=np.int64)
        order = np.lexsort((low, h2, h1))
        h1, h2, low = h1[order], h2[order], low[order]
        first = _groups(h1, h2)
        h1, h2, low = h1[first], h2[first], low[first]
        windows = W.hash_windows(flat, size)[starts]
        at = np.minimum(np.searchsorted(h1, windows), len(h1) - 1)
        hit = np.flatnonzero(h1[at] == windows)
        second = (W.hash_windows(flat, size, 1)[starts[hit]] >> np.uint64(32)).astype(np.uint32)
        rows = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[starts[hit]]
        at = at[hit]
        while True:  # windows that share the first 64 bits lie side by side
            ahead = np.flatnonzero((h2[at] < second) & (at + 1 < len(h1)) & (h1[np.minimum(at + 1, len(h1) - 1)] == h1[at]))
            if not len(ahead):
                break
            at[ahead] += 1
        good = starts[hit[(h2[at] == second) & (low[at] < ids[rows])]]
        np.add.at(cover, good, 1)
        np.add.at(cover, good + size, -1)
    return np.cumsum(cover)[:-1] > 0


def _apply(size: int, with_text: bool):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts = [b or b"" for b in docs["body"]]
        ids = docs["known"].to_numpy(dtype=np.int64)
        flat, begins = W.hash_words(texts, W.SPACED)
        covered = _covered(flat, begins, ids, answers, size)
        out = []
        for doc_id, body, a, b in zip(ids, texts, begins, begins[1:]):
            own, gone = body.split(), covered[a:b]
            kept = b" ".join(w for w, g in zip(own, gone) if not g) if gone.any() else b" ".join(own)
            out.append((None if doc_id == _NO_ID else int(doc_id), len(own), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if with_text else None))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})

    return run


def substring_dedup(docs: DataFrame, size: int = 13, max_cells: int = 1 << 29, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): one row per document row, without the words of
    windows that also start in a smaller document. ``kept`` joins the kept words by one blank; it is
    null when ``with_text`` is off."""
    spark = docs.sparkSession
    W.small_batches(spark)
    body = W.texts_of(docs)
    n_bytes = body.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    windows = n_bytes // 6 + 1
    bits = max(3, min(max_cells.bit_length() - 1, (4 * windows - 1).bit_length()))
    shard_bits = max(0, (windows // _WINDOWS_PER_SHARD).bit_length())
    buckets = max(1, windows // _WORDS_PER_BUCKET)
    keyed = body.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int"))
    sketch = spark.sparkContext.broadcast(repeated_cells(body, size, bits))
    entries = keyed.mapInArrow(W.frugal(_candidates(size, bits, shard_bits, sketch)), ENTRIES)
    answers = stage(entries.groupBy("shard").applyInPandas(_answer, ANSWERS), "substring-answers")
    known = keyed.select("bucket", F.coalesce("doc_id", F.lit(_NO_ID)).alias("known"), "body")
    done = known.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInPandas(_apply(size, with_text), RESULT)
    return done if with_text else done.drop("kept")


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)
