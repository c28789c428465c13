"""A hidden Markov language model over word tokens.

1. Words of all training texts are counted: per task, then by a shuffle on the word's 64-bit hash.
2. Every text becomes a sequence of symbols: the most frequent words have their own (a fixed
   number), all others share one, and each text closes with the end symbol. Sums that only need
   counts of frequent words are taken from a broadcast table of fixed size; rarer words meet
   their counts in a join.
3. Baum-Welch: every pass goes over all training texts; each task runs the scaled forward and
   backward recursions over whole texts and emits expected counts, which are summed by symbol range.
   On the way back forward states are found again span by span, so a long text takes little memory.
4. The scaled forward recursion over the whole text gives its likelihood exactly. A word under the
   shared symbol is worth its add-half share among these words.

Training starts from states that are counted over all training documents: each document counts for the one of
several centres that it is most like. Only these centres come from a sample, of at most ``_SEED_DOCS`` whole documents.

Defined cases: null, empty and blank texts are one end token. A null ``doc_id`` has no remainder:
such a row is not held out and trains. Rows that repeat a ``doc_id`` count and are scored one by
one. Without training rows every word has probability one in the base and the model knows only the
end and the shared symbol. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.sources.stores import stage

_TABLE_WORDS = 1 << 18
_SYMBOLS = (1 << 16) - 2
_END, _OTHER = _SYMBOLS, _SYMBOLS + 1
_N_SYMBOLS = _SYMBOLS + 2
_SEED_DOCS = 256
_SPAN = 64
_FLUSH = 1 << 21
_SHARD = 1 << 11
_PRIOR = 2000.0


def _count_words(batches):
    pending, held = [], 0

    def flush():
        own = np.sort(np.concatenate(pending))
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        return pa.RecordBatch.from_pydict({
            "word": own[first].view(np.int64), "n": np.diff(np.append(first, len(own))).astype(np.int64)})

    for batch in batches:
        flat, _ = W.hash_words(W.bodies(batch), W.SPACED_LOWER)
        if len(flat):
            pending.append(flat)
            held += len(flat)
        if held >= 2 * _FLUSH:
            yield flush()
            pending, held = [], 0
    if held:
        yield flush()


class Vocabulary:
    """The most frequent words by falling count, and the sums over all words that the model needs."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n_docs: int, n_words: int, total: int):
        self.lookup, self.counts = W.Lookup(words), counts
        self.tokens = total + n_docs
        self.norm = math.log10(self.tokens + 0.5 * (n_words + bool(n_docs) + 1))
        own = counts[:_SYMBOLS]
        rest = total - int(own.sum()) + 0.5 * (n_words - len(own)) + 0.5
        self.rest = math.log10(rest)
        weight = np.zeros(_N_SYMBOLS)
        weight[: len(own)] = own + 0.5
        weight[_END], weight[_OTHER] = n_docs + 0.5, rest
        self.unigram = weight / weight.sum()
        self.end_log, self.n_docs = math.log10(n_docs + 0.5), n_docs


_DOC = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("n_other", pa.int64()),
    ("table_log", pa.float64()), ("other_log", pa.float64()), ("symbols", pa.binary()),
    ("rare", pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())])))])
_DOC_SQL = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, n_other long, table_log double, other_log double, "
    "symbols binary, rare array<struct<word:bigint,n:bigint>>")


def _to_symbols(shared):
    def run(batches):
        vocabulary: Vocabulary = shared.value
        logs = np.log10(vocabulary.counts + 0.5) if len(vocabulary.counts) else np.zeros(1)
        for batch in batches:
            flat, begins = W.hash_words(W.bodies(batch), W.SPACED_LOWER)
            place = vocabulary.lookup.find(flat) if len(vocabulary.counts) else np.full(len(flat), -1, dtype=np.int32)
            listed, own = place >= 0, (place >= 0) & (place < _SYMBOLS)
            symbols = np.where(own, place, _OTHER).astype("<u2")
            log = np.where(listed, logs[np.maximum(place, 0)], 0.0)
            known, other = (np.diff(np.concatenate([[0], np.cumsum(x)])[begins]) for x in (listed, ~own))
            # Sums over a whole batch would lose digits to cancellation.
            table_log = np.array([math.fsum(log[a:b]) for a, b in zip(begins, begins[1:])])
            other_log = np.array([math.fsum(log[a:b][~own[a:b]]) for a, b in zip(begins, begins[1:])])
            end = np.array([_END], dtype="<u2").tobytes()
            rare = []
            for a, b in zip(begins, begins[1:]):
                words, n = np.unique(flat[a:b][~listed[a:b]], return_counts=True)
                rare.append([{"word": w, "n": k} for w, k in zip(words.view(np.int64).tolist(), n.tolist())])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(begins) + 1, pa.int64()),
                pa.array(known + (vocabulary.n_docs > 0), pa.int64()), pa.array(other, pa.int64()),
                pa.array(table_log + vocabulary.end_log), pa.array(other_log),
                pa.array([symbols[a:b].tobytes() + end for a, b in zip(begins, begins[1:])], pa.binary()),
                pa.array(rare, _DOC.field("rare").type)], schema=_DOC)

    return run


class Model:
    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit  # (S), (S, S), (symbols, S)

    def log_likelihoods(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Natural log likelihood of each sequence, by the scaled forward recursion in lockstep."""
        order = np.argsort([-len(s) for s in sequences], kind="stable")
        lengths = np.array([len(sequences[i]) for i in order])
        flat = np.concatenate([sequences[i] for i in order]).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # how many are longer than t
        total = np.zeros(len(lengths))
        alpha = np.repeat(self.start[None, :], len(lengths), axis=0)
        for t, n in enumerate(active):
            if t:
                alpha = alpha[:n] @ self.move
            alpha = alpha * self.emit[flat[at[:n] + t]]
            scale = alpha.sum(axis=1)
            total[:n] += np.log(scale)
            alpha /= scale[:, None]
        out = np.empty(len(lengths))
        out[order] = total
        return out

    def expected(self, texts: list[np.ndarray]):
        """Expected counts (start, move, emit) of whole texts, in lockstep. Forward states are kept before every
        ``_SPAN``-th word only, and made again span by span on the way back."""
        order = np.argsort([-len(s) for s in texts], kind="stable")
        lengths = np.array([len(texts[i]) for i in order])
        flat = np.concatenate([texts[i] for i in order]).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        active = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
        states, steps = len(self.start), len(active)

        def forward(t: int, alpha: np.ndarray):
            alpha = (alpha[: active[t]] @ self.move if t else alpha) * self.emit[flat[at[: active[t]] + t]]
            scale = alpha.sum(axis=1)
            return alpha / scale[:, None], scale

        kept, alpha = [], np.repeat(self.start[None, :], len(lengths), axis=0)
        for t in range(steps):
            if t % _SPAN == 0:
                kept.append(alpha)
            alpha, _ = forward(t, alpha)

        emits, moves = np.zeros((_N_SYMBOLS, states)), np.zeros((states, states))
        symbols, weights, held = [], [], 0
        beta = np.ones((active[-1], states))
        for begin in range((steps - 1) // _SPAN * _SPAN, -1, -_SPAN):
            alphas, scales = [kept.pop()], []
            for t in range(begin, min(begin + _SPAN, steps)):
                alpha, scale = forward(t, alphas[-1])
                alphas.append(alpha)
                scales.append(scale)
            for t in range(begin + len(scales) - 1, begin - 1, -1):
                n = active[t]
                if len(beta) < n:
                    beta = np.concatenate([beta, np.ones((n - len(beta), states))])
                own = flat[at[:n] + t]
                gamma = alphas[t - begin + 1] * beta
                symbols.append(own)
                weights.append(gamma)
                held += n
                if held >= _FLUSH // 8 or not t:
                    every, weight = np.concatenate(symbols), np.concatenate(weights)
                    for s in range(states):
                        emits[:, s] += np.bincount(every, weights=weight[:, s], minlength=_N_SYMBOLS)
                    symbols, weights, held = [], [], 0
                if t:
                    ahead = self.emit[own] * beta / scales[t - begin][:, None]
                    moves += alphas[t - begin][:n].T @ ahead
                    beta = ahead @ self.move.T
        return gamma.sum(axis=0), moves * self.move, emits


def _texts_as_symbols(batch) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype="<u2") for b in batch.column("symbols").to_pylist()]


def _in_shards(start: np.ndarray, moves: np.ndarray, emits: np.ndarray):
    """Counts of a task: emissions by symbol range; start and moves as range -1."""
    shards = [emits[k : k + _SHARD].astype(np.float64).tobytes() for k in range(0, _N_SYMBOLS, _SHARD)]
    return pa.RecordBatch.from_pydict({
        "shard": pa.array([-1, *range(len(shards))], pa.int32()),
        "sums": [np.concatenate([start, moves.ravel()]).astype(np.float64).tobytes(), *shards]})


def _count_in_groups(count):
    """The sums of ``count``, a function from a list of texts to (start, moves, emits), over the texts of a task."""
    def run(batches):
        sums, texts, held = None, [], 0

        def settle():
            new = count(texts)
            return new if sums is None else tuple(a + b for a, b in zip(sums, new))

        for batch in batches:
            for text in _texts_as_symbols(batch):
                texts.append(text)
                held += len(text)
                if held >= _FLUSH // 2:
                    sums, texts, held = settle(), [], 0
        if texts:
            sums = settle()
        if sums is not None:
            yield _in_shards(*sums)

    return run


def _expect(shared):
    """Expected counts of a task under a model."""
    return _count_in_groups(lambda texts: shared.value.expected(texts))


def _assign(shared):
    """Counts of a task where each text belongs to the one centre that it is most like; no moves."""
    def count(texts: list[np.ndarray]):
        log = shared.value
        states = log.shape[1]
        emits, groups = np.zeros(_N_SYMBOLS * states), np.zeros(states)
        for text in texts:
            symbols, n = np.unique(text.astype(np.int64), return_counts=True)
            best = int((log[symbols] * n[:, None]).sum(axis=0).argmax())
            groups[best] += 1
            emits[symbols * states + best] += n
        return groups, np.zeros((states, states)), emits.reshape(_N_SYMBOLS, states)

    return _count_in_groups(count)


def _add(frames):
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for shard, blob in zip(frame["shard"], frame["sums"]):
            sums[shard] = sums.get(shard, 0.0) + np.frombuffer(blob, dtype=np.float64)
    for shard, values in sums.items():
        yield pd.DataFrame({"shard": [shard], "sums": [values.tobytes()]})


def _model_of(start, moves, emits, unigram) -> Model:
    """Parameters from expected counts; emissions lean on the unigram by a fixed weight."""
    emit = (emits + _PRIOR * unigram[:, None]) / (emits.sum(axis=0) + _PRIOR)
    move = moves + 0.5
    start = start + 0.5
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit)


def _likeness(emit: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """What a symbol adds to the likeness of a text to each centre; for unused symbols any number."""
    return np.log(np.maximum(emit, 1e-300) / np.maximum(unigram, 1e-300)[:, None])


def _centres(texts: list[np.ndarray], states: int, unigram: np.ndarray) -> np.ndarray:
    """Emissions of ``states`` centres of a few whole documents: far-apart seeds, then a few rounds of hard assignment."""
    bags = [np.unique(t, return_counts=True) for t in texts]
    member = np.zeros(len(texts), dtype=int)

    def emissions(groups):
        counts = np.zeros((_N_SYMBOLS, states))
        for (symbols, n), g in zip(bags, groups):
            if g >= 0:
                counts[symbols, g] += n
        return (counts + 50.0 * unigram[:, None]) / (counts.sum(axis=0) + 50.0)

    def gains(emit):
        log = _likeness(emit, unigram)
        return np.array([(log[s] * n[:, None]).sum(axis=0) / n.sum() for s, n in bags])

    if not texts:
        return np.repeat(unigram[:, None], states, axis=1)
    sizes = np.array([n.sum() for _, n in bags])
    chosen = [int(sizes.argmax())]
    while len(chosen) < min(states, len(texts)):
        groups = np.full(len(texts), -1)
        groups[chosen] = range(len(chosen))
        # The text least like any seed so far; short texts gain by chance and are made less attractive.
        likeness = gains(emissions(groups))[:, : len(chosen)].max(axis=1) + 20.0 / np.sqrt(sizes)
        likeness[chosen] = np.inf
        chosen.append(int(likeness.argmin()))
    groups = np.full(len(texts), -1)
    groups[chosen] = range(len(chosen))
    for _ in range(8):
        member = groups = gains(emissions(groups)).argmax(axis=1)
    return emissions(member)


def _first_model(groups: np.ndarray, emits: np.ndarray, unigram: np.ndarray) -> Model:
    """The model that training starts from, of documents counted by centre."""
    states = len(groups)
    emit = (emits + 50.0 * unigram[:, None]) / (emits.sum(axis=0) + 50.0)
    start = groups + 1.0
    move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), 0.8 * emit + 0.2 * unigram[:, None])


def _score(shared):
    schema = pa.schema([("uid", pa.int64()), ("log_hmm", pa.float64())])

    def run(batches):
        model: Model = shared.value
        ids, texts, held = [], [], 0

        def settle():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(model.log_likelihoods(texts) / math.log(10))], schema=schema)

        for batch in batches:
            for uid, text in zip(batch.column("uid").to_pylist(), _texts_as_symbols(batch)):
                ids.append(uid)
                texts.append(text)
                held += len(text)
            if held >= _FLUSH:
                yield settle()
                ids, texts, held = [], [], 0
        if ids:
            yield settle()

    return run


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """The words of (word, c) above a count class, to about ``most`` words; of the class that would exceed it a share by hash.
    Classes are single counts up to 1024 and 64 per doubling beyond, so some thousand rows decide the cut."""
    c = F.col("c")
    kind = F.when(c <= 1024, c).otherwise(1024 + F.floor(64 * F.log2(c / 1024))).cast("long")
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(kind.alias("k")).count().collect()), reverse=True)
    held = 0
    for k, n in sizes:
        if held + n > most:
            room = most - held
            share = max(0.0, room - 4.0 * room**0.5) / n  # a hash gives out more than the room about once in 30,000 times
            return counts.where((kind > F.lit(k)) | ((kind == F.lit(k)) & (F.shiftrightunsigned(F.xxhash64("word"), 32) < F.lit(int(share * 2**32)))))
        held += n
    return counts


def language_model_scores(docs: DataFrame, states: int = 8, passes: int = 2) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text, held_out), learned from those not held out: n_tokens,
    n_known, train_tokens, base_score (add-half unigram) and score (hidden Markov model), in log10."""
    spark = docs.sparkSession
    W.small_batches(spark)
    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col("text").cast("string").cast("binary").alias("body"))
    training = body.where(~F.col("held_out"))
    counts = stage(training.select("body").mapInArrow(W.frugal(_count_words), "word long, n long").groupBy("word").agg(F.sum("n").alias("c")), "words")
    n_words, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    listed = frequent_words(counts, _TABLE_WORDS).toPandas().sort_values(["c", "word"], ascending=[False, True])
    vocabulary = Vocabulary(listed["word"].to_numpy(np.int64).view(np.uint64), listed["c"].to_numpy(np.int64), training.count(), n_words, int(total))
    known = spark.sparkContext.broadcast(vocabulary)
    texts = stage(body.mapInArrow(W.frugal(_to_symbols(known)), _DOC_SQL).withColumn("uid", F.monotonically_increasing_id()), "symbols")

    trained = texts.where(~F.col("held_out")).select("doc_id", "symbols")
    sample = W.least_rows(trained, F.xxhash64("doc_id", "symbols"), _SEED_DOCS).collect()
    unigram = vocabulary.unigram

    def summed(count, shared):
        """(start, moves, emits) over all training texts."""
        parts = trained.select("symbols").mapInArrow(W.frugal(count(shared)), "shard int, sums binary").repartition("shard").mapInPandas(_add, "shard int, sums binary")
        head, emits = np.zeros(states + states * states), np.zeros((_N_SYMBOLS, states))
        for shard, blob in parts.collect():
            values = np.frombuffer(bytes(blob), dtype=np.float64)
            if shard < 0:
                head = values
            else:
                emits[shard * _SHARD : (shard + 1) * _SHARD] = values.reshape(-1, states)
        shared.unpersist()
        return head[:states], head[states:].reshape(states, states), emits

    centres = _centres([np.frombuffer(bytes(r["symbols"]), dtype="<u2").astype(np.int64) for r in sample], states, unigram)
    groups, _, emits = summed(_assign, spark.sparkContext.broadcast(_likeness(centres, unigram)))
    model = _first_model(groups, emits, unigram)
    for _ in range(passes):
        model = _model_of(*summed(_expect, spark.sparkContext.broadcast(model)), unigram)

    rare = texts.select("uid", F.inline("rare")).join(counts, "word", "left").groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"),
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
    scored = texts.select("uid", "symbols").mapInArrow(_score(spark.sparkContext.broadcast(model)), "uid long, log_hmm double")
    out = texts.drop("symbols", "rare").join(scored, "uid").join(rare, "uid", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("table_log") + rare_log - F.col("n_tokens") * F.lit(vocabulary.norm)).alias("base_score"),
        (F.col("log_hmm") + F.col("other_log") + rare_log - F.col("n_other") * F.lit(vocabulary.rest)).alias("score"))


def op10_hmm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return language_model_scores(docs.withColumn("held_out", F.coalesce(W.crc_class(5) == 1, F.lit(False))).select("doc_id", "text", "held_out"))
