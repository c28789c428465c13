"""Periodic runs in word sequences: seeds on diagonals, extended once per lag.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least
``least`` words and ``repeats`` periods long, that no neighbouring word extends. It agrees with itself
shifted by q on at least max(least - q, (repeats - 1) * q) words, which bounds the seeds: for lags from
2**j up to 2**(j + 1) every such overlap holds a whole block of 2**j words that starts at a multiple of
2**j. So for each j the 2**j-grams of a text are indexed (equal ones side by side, by place), each block
is paired with the same gram at the lags of its class, and the pair's diagonal is extended both ways.
A block has at most 2**j such partners, so a text of n words gives at most n pairs for each j, however
repetitive it is. Pairs inside a stretch already found at their lag are skipped: for each lag of a text,
the end of the furthest extension is kept. A stretch of period q shows at the lags 2q, 3q, ... as well;
the least lag of equal stretches is the smallest period.

Grams are named exactly (equal names if and only if equal words), each length from two halves. Texts
are worked through together, many short ones at a time, without a shuffle. Memory follows the longest
text: about 200 bytes a word.

Defined cases: null texts stay null and empty or blank ones become empty, all without runs. Texts that
repeat are judged one by one. Columns other than ``text`` pass through untouched, but for columns named
like the two that are added (any case).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillgauge.llm import words as W

LEAST, REPEATS = 24, 3
_WORDS = 1 << 17
_ADDED = ("n_words", "runs")
_RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
_RUNS = T.ArrayType(_RUN)
_EMPTY = np.empty(0, dtype=np.int64)


def _named(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each pair, equal for equal pairs, and the order of the pairs by it."""
    key = left * np.int64(right.max() + 1) + right
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    numbers = np.empty(len(key), dtype=np.int64)
    numbers[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]))
    return numbers, order


def _seed_pairs(places, names, texts, blocks, low: int, high: int):
    """(place, lag) of the blocks and the occurrences of their gram at lags from ``low`` up to ``high``.

    ``places`` are ordered by name, then place; ``blocks`` are indices into them."""
    found, step = [], 0
    while len(blocks):
        step += 1
        blocks = blocks[blocks + step < len(places)]
        other = blocks + step
        lag = places[other] - places[blocks]
        on = (names[other] == names[blocks]) & (lag < high) & (texts[other] == texts[blocks])
        blocks, lag = blocks[on], lag[on]
        found.append((places[blocks[lag >= low]], lag[lag >= low]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (_EMPTY, _EMPTY)


class _Texts:
    """Word codes of several texts, each followed by a gap of code -1, and the names of their 2**j-grams."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(x) for x in texts], dtype=np.int64)
        self.begins = np.concatenate([[0], np.cumsum(lengths + 1)])
        gap = np.full(1, -1, dtype=np.int64)
        self.grams = [np.concatenate([y for x in texts for y in (x, gap)]).astype(np.int32)]
        self.text = np.repeat(np.arange(len(texts)), lengths + 1)
        self.size = lengths[self.text]
        self.place = np.arange(len(self.text))
        self.offset = self.place - self.begins[self.text]

    def index(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Names the grams twice as long as the longest so far, of texts with ``least`` words: (places, names) in order."""
        half = 1 << (len(self.grams) - 1)
        at = np.flatnonzero((self.size >= least) & (self.offset + 2 * half <= self.size))
        if not len(at):
            return _EMPTY, _EMPTY
        last = self.grams[-1]
        names, order = _named(last[at].astype(np.int64), last[at + half].astype(np.int64))
        grown = np.full(len(last), -1, dtype=np.int32)
        grown[at] = names
        self.grams.append(grown)
        return at[order], names[order]

    def agreeing(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """On how many words the text agrees from ``a`` and ``b`` on (before them, if ``back``); a < b, in one text."""
        far, floor = np.zeros(len(a), dtype=np.int64), self.begins[self.text[a]]
        for level in reversed(range(len(self.grams))):
            gram, width, live = self.grams[level], 1 << level, np.arange(len(a))
            while len(live):
                move = -far[live] - width if back else far[live]
                x, y = a[live] + move, b[live] + move
                inside = x >= floor[live] if back else y < len(gram)
                live, x, y = live[inside], x[inside], y[inside]
                live = live[(gram[x] == gram[y]) & (gram[x] >= 0)]
                far[live] += width
        return far

    def extend(self, place: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """The stretches (start, end, lag) through the pairs, each found once."""
        order = np.lexsort((place, lag, self.text[place]))
        place, lag, out = place[order], lag[order], []
        while len(place):
            group = np.cumsum(np.concatenate([[False], (lag[1:] != lag[:-1]) | (self.text[place[1:]] != self.text[place[:-1]])]))
            first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            a, q = place[first], lag[first]
            furthest = a + self.agreeing(a, a + q, back=False)
            out.append(np.stack([a - self.agreeing(a, a + q, back=True), furthest + q, q]))
            left = place >= furthest[group]
            place, lag = place[left], lag[left]
        return np.concatenate(out, axis=1) if out else np.empty((3, 0), dtype=np.int64)


def find_runs(texts: list[np.ndarray], least: int = LEAST, repeats: int = REPEATS) -> list[np.ndarray]:
    """For every text of word codes the rows (start, length, period) of its runs by start, then period."""
    if repeats < 3 or least < 3:
        raise ValueError("runs have at least three periods and three words")
    if not texts:
        return []
    base = max(0, (2 * least // 3 + 1).bit_length() - 2)  # blocks of 2**base lie in the least overlap of any lag
    own, found, level = _Texts(texts), [], 0
    while True:
        width = 1 << level
        if level:
            places, names = own.index(least if level <= base else max(least, repeats * width))
        else:
            places = np.flatnonzero(own.grams[0] >= 0)
            if not base:
                places = places[np.argsort(own.grams[0][places], kind="stable")]
            names = own.grams[0][places]
        if not len(places):
            break
        if level >= base:
            blocks = np.flatnonzero(own.offset[places] % width == 0)
            found.append(_seed_pairs(places, names, own.text[places], blocks, 1 if level == base else width, 2 * width))
        level += 1
    place, lag = (np.concatenate(x) for x in zip(*found)) if found else (_EMPTY, _EMPTY)
    fits = repeats * lag <= own.size[place]
    start, end, lag = own.extend(place[fits], lag[fits])
    fits = end - start >= np.maximum(least, repeats * lag)
    start, end, lag = start[fits], end[fits], lag[fits]
    order = np.lexsort((lag, end, start))
    start, end, lag = start[order], end[order], lag[order]
    least_lag = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[: len(start)]
    start, end, lag = start[least_lag], end[least_lag], lag[least_lag]
    order = np.lexsort((lag, start))
    rows = np.stack([start - own.begins[own.text[start]], end - start, lag], axis=1)[order]
    return np.split(rows, np.searchsorted(own.text[start[order]], np.arange(1, len(texts))))


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words less those that any run holds after its first period, joined by one blank."""
    if len(runs):
        edges = np.zeros(len(words) + 1, dtype=np.int64)
        np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "replace")


def _work(texts: list[bytes], least: int, repeats: int):
    """(words, runs, collapsed text) of each text."""
    codes: dict[bytes, int] = {}
    split = [x.split() for x in texts]
    runs = find_runs([np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=len(words)) for words in split], least, repeats)
    return [(len(words), own, _collapsed(words, own)) for words, own in zip(split, runs)]


def _scan(least: int, repeats: int):
    def run(batches):
        for batch in batches:
            texts, out, at = batch.column("body").to_pylist(), [], 0
            while at < len(texts):
                to, held = at, 0
                while to < len(texts) and held < 6 * _WORDS:  # bytes; a word has about six
                    held += len(texts[to] or b"")
                    to += 1
                out += _work([x or b"" for x in texts[at:to]], least, repeats)
                at = to
            flat = np.concatenate([own for _, own, _ in out]) if out else np.empty((0, 3), dtype=np.int64)
            parts = pa.StructArray.from_arrays([pa.array(flat[:, k], pa.int64()) for k in range(3)], names=_RUN.names)
            offsets = np.concatenate([[0], np.cumsum([len(own) for _, own, _ in out])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), pa.array([None if t is None else x for t, (_, _, x) in zip(texts, out)], pa.string()),
                pa.array([n for n, _, _ in out], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), parts)], names=["row", "text", *_ADDED])

    return run


def collapse_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``docs`` with the text less what runs repeat, and two columns: n_words (before) and the runs, an
    array of (start, length, period) in words by start, then period."""
    W.small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c.lower() not in _ADDED]
    rest = [c for c in names if c.lower() != "text"]
    row = F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(0).alias("_")).alias("row")
    packed = docs.select(row, F.col("text").cast("string").cast("binary").alias("body"))
    schema = T.StructType([packed.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("runs", _RUNS)])
    found = packed.mapInArrow(W.frugal(_scan(least, repeats)), schema)
    return found.select(*[F.col("text").alias(c) if c.lower() == "text" else F.col("row").getField(c).alias(c) for c in names], *_ADDED)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the repeats that the query's contract plants, by built-in functions.

    With h = crc32(doc_id) and g = h div 10: if h is divisible by 10, the words from a = g % n on repeat the p
    words there, p = 1 + (n - a) div (3 + g % 8). Rows without a doc_id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = own.withColumns({"h": h, "g": F.floor(h / 10).cast("long")})
    words = F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    keyed = keyed.withColumn("words", words)
    keyed = keyed.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    keyed = keyed.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    repeated = F.expr("array_join(transform(sequence(0, n - 1), i -> words[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')")
    return keyed.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    found = collapse_runs(planted(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    best = F.expr("""reduce(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>),
        (b, r) -> if(b is null or r.length * b.period > b.length * r.period, r, b))""")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("collapsed_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, CAST(doc_id AS VARCHAR) AS s FROM documents),
k AS (
  SELECT *, len(ws) AS n, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(s) + 1), lambda i: [CAST(ascii(substr(s, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END))) AS h FROM d),
p AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM k),
w AS (
  SELECT rid, doc_id, n, CASE WHEN a >= n THEN ws ELSE
    list_transform(range(0, n), lambda i: ws[CAST(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END AS BIGINT)]) END AS ws FROM p),
t AS (SELECT rid, n, i, array_to_string(ws[i + 1 : i + 8], ' ') AS gram FROM (SELECT *, unnest(range(0, n - 7)) AS i FROM w WHERE n >= 24)),
e AS (SELECT x.rid, x.i, y.i - x.i AS q FROM t x JOIN t y ON x.rid = y.rid AND x.gram = y.gram AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
f AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM e),
z AS (SELECT rid, q, min(i) AS s, count(*) + 7 + q AS l FROM f GROUP BY rid, q, island HAVING count(*) + 7 + q >= greatest(24, 3 * q)),
r AS (SELECT rid, s, l, min(q) AS q FROM z GROUP BY rid, s, l),
b AS (SELECT rid, s, l, q FROM r QUALIFY row_number() OVER (PARTITION BY rid ORDER BY (l // q) DESC, CAST(l % q AS DOUBLE) / q DESC, s, q) = 1),
u AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs FROM r GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM r),
kept AS (
  SELECT x.rid, string_agg(x.v, ' ' ORDER BY x.i) AS body FROM (SELECT rid, unnest(ws) AS v, unnest(range(0, n)) AS i FROM w) x
  LEFT JOIN gone USING (rid, i) WHERE gone.rid IS NULL GROUP BY x.rid)
SELECT w.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period, 1000 * b.l // b.q AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM w LEFT JOIN u USING (rid) LEFT JOIN b USING (rid) LEFT JOIN kept USING (rid)
"""
