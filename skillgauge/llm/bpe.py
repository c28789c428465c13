"""BPE encoding and decoding with a contiguous rank array.

A word is a row of parts with the rank of every adjacent pair beside it. The least rank (leftmost
on ties) names the next merge: its boundary is deleted, the arrays close up, and the two
neighbouring ranks are looked up again, until no pair has a rank. Words of one length are rows of
one matrix, so a scan or a deletion is one numpy operation for thousands of words. Words beyond
``_SHORT`` bytes go through a heap over linked parts instead, which gives the same merges without
quadratic scans.

Every task keeps a bounded table of words it has encoded. There is no shuffle; the vocabulary
(fixed size) is read on the driver and broadcast. Texts are encoded whole: special tokens first,
then canonical composition, lower case, and the tokenizer's word pattern.

Defined cases: null reads as the empty text, which has no tokens and decodes to the empty text.
Rows that repeat a ``doc_id`` are encoded one by one. Columns other than ``doc_id`` and ``text``
are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillgauge.llm import words as W

_SHORT = 48
_CACHED_WORDS = 120_000
_NONE = np.iinfo(np.int32).max


def _byte_names() -> list[str]:
    """The printable stand-ins of the byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in order."""
    printable = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Model:
    """Vocabulary and merges of a word-end BPE tokenizer, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in pre] != ["Split", "ByteLevel"] or spec["decoder"]:
            raise ValueError(f"{path}: not a lower-casing word-end BPE tokenizer")
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.pattern = pre[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * self.size
        for token, number in [*vocab.items(), *self.special.items()]:
            self.tokens[number] = token.encode()
        names = _byte_names()
        self.inner = np.array([vocab[n] for n in names], dtype=np.int32)
        self.last = np.array([vocab[n + end] for n in names], dtype=np.int32)
        left = np.array([vocab[a] for a, _ in model["merges"]], dtype=np.int64)
        right = np.array([vocab[b] for _, b in model["merges"]], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in model["merges"]], dtype=np.int32)
        keys = left * self.size + right
        self.made = made
        # Open addressing: a pair sits within a few slots of its hash.
        self.bits = 18
        slots = np.full(1 << self.bits, -1, dtype=np.int64)
        ranks = np.full(1 << self.bits, _NONE, dtype=np.int32)
        self.reach = 1
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            step = 1
            while slots[at] >= 0 and slots[at] != key:
                at, step = (at + 1) & ((1 << self.bits) - 1), step + 1
            if slots[at] < 0:
                slots[at], ranks[at] = key, rank
            self.reach = max(self.reach, step)
        self.slots, self.ranks = slots, ranks

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, ``_NONE`` where there is none."""
        keys = left.astype(np.int64) * self.size + right
        at = self._slot(keys)
        out = np.where(self.slots[at] == keys, self.ranks[at], _NONE)
        open_ = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] >= 0))
        for _ in range(self.reach - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            seen = self.slots[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
        return out

    def merge_rows(self, parts: np.ndarray) -> list[np.ndarray]:
        """Final parts of words of one length; ``parts`` is (words, length)."""
        n, length = parts.shape
        results: list[np.ndarray | None] = [None] * n
        rows = np.arange(n)
        ranks = self.rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(n, length - 1)
        while length > 1:
            best = np.argmin(ranks, axis=1)
            lines = np.arange(len(rows))
            least = ranks[lines, best]
            over = np.flatnonzero(least == _NONE)
            if len(over):
                for i in over:
                    results[rows[i]] = parts[i].copy()
                on = least != _NONE
                rows, parts, ranks, best, least = rows[on], parts[on], ranks[on], best[on], least[on]
                lines = np.arange(len(rows))
            if not len(rows):
                return results
            parts[lines, best] = self.made[least]
            columns = np.arange(length - 1)
            parts = np.take_along_axis(parts, columns + (columns > best[:, None]), axis=1)
            length -= 1
            if length == 1:
                break
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= best[:, None]), axis=1)
            left, right = np.flatnonzero(best > 0), np.flatnonzero(best < length - 1)
            b = best[left]
            ranks[left, b - 1] = self.rank(parts[left, b - 1], parts[left, b])
            b = best[right]
            ranks[right, b] = self.rank(parts[right, b], parts[right, b + 1])
        for i, row in zip(rows, parts):
            results[i] = row
        return results

    def merge_long(self, parts: np.ndarray) -> np.ndarray:
        """The same merges for one long word: a heap of (rank, position) over linked parts."""
        own = parts.tolist()
        n = len(own)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        first = self.rank(parts[:-1], parts[1:])
        heap = [(int(r), i, own[i], own[i + 1]) for i, r in enumerate(first) if r != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if own[i] == a else -1
            if j < 0 or own[j] != b:
                continue
            own[i], own[j] = int(self.made[rank]), -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    r = int(self.rank(np.array([own[x]]), np.array([own[y]]))[0])
                    if r != _NONE:
                        heapq.heappush(heap, (r, x, own[x], own[y]))
        return np.array([p for p in own if p >= 0], dtype=np.int32)

    def encode_words(self, found: list[bytes]) -> list[bytes]:
        """Ids of distinct non-empty words, each as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(found)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(found):
            by_length.setdefault(len(word), []).append(i)
        for length, which in by_length.items():
            for at in range(0, len(which), 20_000):
                some = which[at : at + 20_000]
                raw = np.frombuffer(b"".join([found[i] for i in some]), dtype=np.uint8).reshape(len(some), length)
                parts = self.inner[raw]
                parts[:, -1] = self.last[raw[:, -1]]
                if length == 1:
                    done = list(parts)
                elif length <= _SHORT:
                    done = self.merge_rows(parts)
                else:
                    done = [self.merge_long(p) for p in parts]
                for i, ids in zip(some, done):
                    out[i] = ids.astype("<u4").tobytes()
        return out


class Encoder:
    """A model with the word table of one task."""

    def __init__(self, model: Model):
        self.model, self.words = model, {}
        self.find = regex.compile(model.pattern).findall
        names = sorted(model.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else lambda text: [text]
        self.special = {name: np.array([n], dtype="<u4").tobytes() for name, n in model.special.items()}

    def split(self, text: str) -> list:
        """Words of a text in order; a special token is its ids."""
        out: list = []
        for piece in self.cut(text) if "<" in text or not all("<" in n for n in self.special) else [text]:
            if piece in self.special:
                out.append(self.special[piece])
                continue
            if not piece.isascii():
                piece = unicodedata.normalize("NFC", piece)
            # Lower case letter by letter: a capital sigma has no word-final form here.
            piece = piece.lower() if "Σ" not in piece else "".join(map(str.lower, piece))
            out += self.find(piece)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        if len(self.words) > _CACHED_WORDS:
            self.words.clear()
        new = [w for w in set().union(*split) if isinstance(w, str) and w not in self.words]
        self.words.update(zip(new, self.model.encode_words([w.encode() for w in new])))
        known = self.words
        return [b"".join([w if isinstance(w, bytes) else known[w] for w in own]) for own in split]

    def decode(self, ids: bytes) -> bytes:
        """Token texts joined by one blank."""
        tokens = self.model.tokens
        return b" ".join([tokens[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker process and broadcast model."""
    model = shared.value
    if id(model) not in _encoders:
        _encoders.clear()
        _encoders[id(model)] = Encoder(model)
    return _encoders[id(model)]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): ids of the whole text, without added special tokens, as little-endian unsigned
    32-bit integers. ``path`` is a tokenizer file on the driver."""
    spark = docs.sparkSession
    W.small_batches(spark)
    shared = spark.sparkContext.broadcast(Model(path))

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(encoder.encode(texts), pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(W.frugal(run), "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the text of each row of ids."""
    shared = encoded.sparkSession.sparkContext.broadcast(Model(path))

    def run(batches):
        encoder = _encoder(shared)
        for batch in batches:
            texts = [encoder.decode(b or b"") for b in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(W.frugal(run), "doc_id long, ids binary, decoded string")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    path = path or default_path()
    return decode(encode(docs, path), path).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
