"""Language identification with language-bitmask n-gram filters.

Letter trigrams are counted per language over all training documents. A language holds a
trigram when the trigram's rate in it is at least the language's even share of the rates over all
languages. The held trigrams go into one Bloom filter whose cells are language bitmasks: the AND
of a trigram's cells answers for all languages at once. A document is decided by the popcount per
language over all its trigrams, corrected by the language's false-positive rate.

The filter has a fixed number of cells, so what is broadcast depends on the number of languages
only. Trigrams are exact codes (three 21-bit code points); counts are combined per task before the
shuffle, so a language with most of the rows is no hot key.

Defined cases: a null text or one without letters is ``und`` with score 0 and teaches nothing. A
text whose trigrams are all unknown gets the language with most trigrams. Equal counts go to
the language with more trigrams, then to the smaller name. Without any labelled training document
every row is ``und``. A null ``doc_id`` has no remainder: it is not held out and does not train.
Rows that repeat a ``doc_id`` count one by one. Other columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.sources.stores import stage

UNKNOWN = "und"
_CELL_BITS = 20
_PROBES = 3
_PIECE = 1 << 19
_FLUSH = 1 << 20
_state: dict[str, np.ndarray] = {}


def _letter_table() -> np.ndarray:
    if "letters" not in _state:
        _state["letters"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)
    return _state["letters"]


def _pieces(texts: list[str | None]):
    """(row, piece) of all texts; a long text is cut at blanks."""
    for row, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = at + _PIECE
            if end < len(text):
                blank = text.rfind(" ", at + 1, end)
                end = blank if blank > at else end
            yield row, text[at:end]
            at = end


def trigrams(texts: list[str | None]):
    """Yields (rows, codes): the text each trigram comes from (ascending) and its code. Trigrams of
    lower-cased letters, words padded by one blank; none crosses a word."""
    rows, pieces, held = [], [], 0

    def emit():
        lowered = [" " + p.lower() + " " for p in pieces]
        joined = "".join(lowered)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        owner = np.repeat(np.array(rows), [len(p) for p in lowered])
        codes[~_letter_table()[codes]] = 0
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0  # one blank after each word
        keep[:-1] |= codes[1:] != 0  # and one before it
        codes, owner = codes[keep], owner[keep]
        grams = codes[:-2] | codes[1:-1] << 21 | codes[2:] << 42
        inside = codes[1:-1] != 0
        return owner[1:-1][inside], grams[inside]

    for row, piece in _pieces(texts):
        rows.append(row)
        pieces.append(piece)
        held += len(piece)
        if held >= _PIECE:
            yield emit()
            rows, pieces, held = [], [], 0
    if pieces:
        yield emit()


def _count(batches):
    """(lang, gram, n) per task."""
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    pending: dict[str, list[np.ndarray]] = {}
    sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    held = 0

    def settle():
        for lang, parts in pending.items():
            codes = np.sort(np.concatenate(parts))
            first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
            sums.setdefault(lang, []).append((codes[first], np.diff(np.append(first, len(codes)))))
        pending.clear()

    def drain():
        for lang, parts in sums.items():
            grams, counts = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(grams, kind="stable")
            grams, counts = grams[order], counts[order]
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(first)), pa.array(grams[first]), pa.array(np.add.reduceat(counts, first), pa.int64())], schema=schema)
        sums.clear()

    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), dtype=object)
        for rows, codes in trigrams(batch.column("text").to_pylist()):
            of = langs[rows]
            for lang in set(of):
                pending.setdefault(lang, []).append(codes[of == lang])
            held += len(codes)
        if held >= _FLUSH:
            settle()
            held = 0
            if sum(len(g) for parts in sums.values() for g, _ in parts) > _FLUSH:
                yield from drain()
    settle()
    yield from drain()


def _probe(grams: np.ndarray, which: int) -> np.ndarray:
    return (W.mix(grams.astype(np.uint64), which + 1) >> np.uint64(64 - _CELL_BITS)).astype(np.int64)


def _filter_cells(batches):
    for batch in batches:
        grams, lang = np.asarray(batch.column("gram")), np.asarray(batch.column("number"))
        cells = np.concatenate([_probe(grams, k) for k in range(_PROBES)])
        lang = np.tile(lang, _PROBES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(lang >> 3, pa.int32()), pa.array(1 << (lang & 7), pa.int32())], names=["cell", "byte", "bit"])


class Filters:
    """Bit-sliced Bloom filters: one bitmask of languages per cell."""

    def __init__(self, langs: list[str], masks: np.ndarray):
        self.langs, self.masks = langs, masks
        held = [(masks[:, i >> 3] >> (i & 7) & 1).mean() for i in range(len(langs))]
        self.false = np.array(held) ** _PROBES if langs else np.empty(0)

    def languages(self, grams: np.ndarray) -> np.ndarray:
        """Bitmask of the languages that hold each trigram."""
        out = self.masks[_probe(grams, 0)]
        for k in range(1, _PROBES):
            out &= self.masks[_probe(grams, k)]
        return out


def train(docs: DataFrame) -> Filters:
    """Filters from the rows of (text, lang); rows without a language teach nothing."""
    spark = docs.sparkSession
    W.small_batches(spark)
    counts = stage(
        docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
        .mapInArrow(W.frugal(_count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()
    langs = [r["lang"] for r in sorted(totals, key=lambda r: (-r["total"], r["lang"]))]
    masks = np.zeros((1 << _CELL_BITS, max(1, -(-len(langs) // 8))), dtype=np.uint8)
    if langs:
        numbers = spark.createDataFrame([(r["lang"], langs.index(r["lang"]), r["total"]) for r in totals], "lang string, number int, total long")
        rate = F.col("n") / F.col("total")
        share = rate / F.sum(rate).over(Window.partitionBy("gram"))
        held = counts.join(numbers, "lang").withColumn("share", share).where(F.col("share") >= 1.0 / len(langs)).select("gram", "number")
        cells = held.mapInArrow(_filter_cells, "cell long, byte int, bit int").groupBy("cell", "byte").agg(F.bit_or("bit").alias("bits"))
        for cell, byte, bits in cells.collect():
            masks[cell, byte] = bits
    return Filters(langs, masks)


def predict(texts: list[str | None], filters: Filters) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    n_langs = len(filters.langs)
    total, counts = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), n_langs), dtype=np.int64)
    for rows, codes in trigrams(texts):
        if not len(rows):
            continue
        first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        own, ends = rows[first], np.append(first[1:], len(rows))
        total[own] += ends - first
        masks = filters.languages(codes)
        for i in range(n_langs):
            running = np.concatenate([[0], np.cumsum(masks[:, i >> 3] >> (i & 7) & 1, dtype=np.int64)])
            counts[own, i] += running[ends] - running[first]
    known, score, best = total > 0, np.zeros(len(texts)), np.zeros(len(texts), dtype=int)
    if not n_langs:
        return [UNKNOWN] * len(texts), score
    corrected = np.clip((counts - total[:, None] * filters.false) / (1 - np.minimum(filters.false, 0.999)), 0, None)
    best = corrected.argmax(axis=1)
    score[known] = np.minimum(1.0, corrected[np.arange(len(texts)), best][known] / total[known])
    return [filters.langs[b] if k else UNKNOWN for b, k in zip(best, known)], score


def _predict(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            names, score = predict(batch.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(score)], schema=schema)

    return run


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """(doc_id, lang_pred, score), one row per row of ``docs``, from the text alone."""
    W.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        W.frugal(_predict(shared)), "doc_id long, lang_pred string, score double")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    filters = train(docs.where(W.crc_class(4) != 2))
    return identify(docs, filters).withColumn("held_out", F.coalesce(W.crc_class(4) == 2, F.lit(False))).select(
        "doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, filters: Filters, min_score: float = 0.2) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but those predicted ``und`` or with fewer than
    ``min_score`` of their trigrams in the predicted language."""
    W.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for batch in batches:
            names, score = predict(batch.column("text").cast(pa.string()).to_pylist(), shared.value)
            yield batch.filter(pa.array([n != UNKNOWN and s >= min_score for n, s in zip(names, score)], pa.bool_()))

    return docs.mapInArrow(W.frugal(run), docs.schema)
