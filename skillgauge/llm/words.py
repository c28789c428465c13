"""Words of whole texts as 64-bit hashes, for numpy work inside tasks.

A word class is a 256-byte table over UTF-8 bytes: separators map to a blank, all other bytes to
the byte that stands for them (lower-casing A-Z, for instance). Texts are joined and hashed in
slices cut between words, so memory follows the slice and not the longest text.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BLANK = 0x20
_SLICE = 1 << 20
_ROWS_PER_BATCH = 400
_U = np.uint64


def byte_table(separators, lower: bool) -> bytes:
    """Table of a word class; ``separators`` are the bytes that end a word."""
    table = list(range(256))
    if lower:
        for b in range(ord("A"), ord("Z") + 1):
            table[b] = b + 32
    for b in separators:
        table[b] = _BLANK
    return bytes(table)


_SPACES = [0x20, *range(0x09, 0x0E)]
SPACED = byte_table(_SPACES, lower=False)
SPACED_LOWER = byte_table(_SPACES, lower=True)
ALNUM_LOWER = byte_table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(n, dtype=_U)
    if n > 1:
        with np.errstate(over="ignore"):
            np.multiply.accumulate(np.full(n - 1, base, dtype=_U), out=out[1:])
    return out


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


_BASE = 0x9E3779B97F4A7C15 | 1
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=_U) * _U(2) + _U(1)
_state: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _state or len(_state["up"]) < n:
        size = max(n, _SLICE + 2)
        _state["up"], _state["down"] = powers(_BASE, size), powers(inverse(_BASE), size)
    return _state["up"], _state["down"]


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = h + _U(seed * 0x9E3779B97F4A7C15 % (1 << 64))
    h ^= h >> _U(32)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    return h


def _long_word(word: np.ndarray) -> int:
    """The hash of one word longer than a slice, in pieces."""
    up, _ = _tables(_SLICE)
    total, shift = 0, 1
    for at in range(0, len(word), _SLICE):
        piece = word[at : at + _SLICE]
        total += int((_BYTE_CODES[piece] * up[: len(piece)]).sum(dtype=_U)) * shift
        shift = shift * pow(_BASE, len(piece), 1 << 64) % (1 << 64)
    return total % (1 << 64)


def hash_words(texts: list[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in order, and where each text's words begin (one more at the end)."""
    joined = b" ".join(texts).translate(table) + b" "
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    hashes, starts, at = [], [], 0
    while at < len(joined):
        cut = joined.rfind(b" ", at, at + _SLICE)
        if cut < 0:
            cut = joined.find(b" ", at + _SLICE)
            part = np.frombuffer(joined, dtype=np.uint8, count=cut - at, offset=at)
            lead = int(np.argmax(part != _BLANK))
            hashes.append(np.array([_long_word(part[lead:])], dtype=_U))
            starts.append(np.array([at + lead]))
        else:
            part = np.frombuffer(joined, dtype=np.uint8, count=cut + 1 - at, offset=at)
            up, down = _tables(len(part) + 1)
            inside = np.zeros(len(part) + 1, dtype=np.int8)
            inside[1:] = part != _BLANK
            step = np.diff(inside)
            first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
            sums = np.empty(len(part) + 1, dtype=_U)
            sums[0] = 0
            np.cumsum(_BYTE_CODES[part] * up[: len(part)], out=sums[1:])
            hashes.append((sums[last] - sums[first]) * down[first])
            starts.append(first + at)
        at = cut + 1
    flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=_U)
    where = np.concatenate(starts) if starts else np.empty(0, dtype=np.int64)
    return mix(flat), np.searchsorted(where, begins)


_WINDOW_BASES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def hash_windows(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """One hash for every run of ``size`` consecutive words; empty when there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=_U)
    base = _WINDOW_BASES[which]
    if size <= 4:
        out = words[:n].copy()
        for k in range(1, size):
            out *= _U(base)
            out += words[k : k + n]
        return mix(out, size)
    out = np.empty(n, dtype=_U)
    back = inverse(base)
    for at in range(0, n, _SLICE):
        part = words[at : at + _SLICE + size - 1]
        m = len(part) - size + 1
        key = f"w{which}"
        if key not in _state:
            _state[key], _state[key + "d"] = powers(base, _SLICE + 64), powers(back, _SLICE + 64)
        up = _state[key] if len(part) <= len(_state[key]) else powers(base, len(part))
        sums = np.empty(len(part) + 1, dtype=_U)
        sums[0] = 0
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[at : at + m] = (sums[size : size + m] - sums[:m]) * _state[key + "d"][:m]
    return mix(out, size)


def hash_runs(words: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One hash of the whole word sequence of every text."""
    base = _WINDOW_BASES[1]
    sums = np.zeros(len(words) + 1, dtype=_U)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    first, last = begins[:-1], begins[1:]
    return mix((sums[last] - sums[first]) * powers(inverse(base), len(words) + 1)[first] + (last - first).astype(_U), 5)


def window_starts(begins: np.ndarray, size: int) -> np.ndarray:
    """Positions in the joined words at which a run of ``size`` words stays inside its text."""
    total = int(begins[-1])
    ends = np.repeat(begins[1:], np.diff(begins))
    return np.flatnonzero(np.arange(total) + size <= ends)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, body): the two columns the operators read; other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("body"))


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of one Arrow batch: texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= _ROWS_PER_BATCH:
        spark.conf.set(key, str(_ROWS_PER_BATCH))


def least_rows(df: DataFrame, key: Column, n: int) -> DataFrame:
    """The ``n`` rows of least ``key``. Tasks send ``n`` keys each to find the cut, then only rows within it."""
    keyed = df.withColumn("_key", key)
    cut = keyed.select("_key").orderBy("_key").limit(n).agg(F.max("_key")).first()[0]
    return keyed.where(F.col("_key") <= F.lit(cut)).orderBy("_key").limit(n).drop("_key")


def bodies(batch, name: str = "body") -> list[bytes]:
    """The texts of an Arrow batch; null reads as empty."""
    return [b or b"" for b in batch.column(name).to_pylist()]


def frugal(run):
    """A task function that hands freed memory back at its end: Python workers live on between tasks, and
    what their allocators keep counts against the executor."""
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return wrapped


def crc_class(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


class Lookup:
    """Distinct 64-bit keys to their positions, by open addressing; read-only and cheap to broadcast."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * max(1, len(keys)) - 1).bit_length())
        self.slots = np.zeros(1 << self.bits, dtype=_U)
        self.places = np.full(1 << self.bits, -1, dtype=np.int32)
        self.reach = 1
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.places[at] < 0
            spots, who = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[who]
            self.places[spots], self.slots[spots] = left[won], keys[left[won]]
            stay = np.ones(len(left), dtype=bool)
            stay[won] = False
            left, at = left[stay], (at[stay] + 1) & ((1 << self.bits) - 1)
            self.reach += 1

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys, 21) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is missing."""
        at = self._home(keys)
        out = np.where((self.slots[at] == keys) & (self.places[at] >= 0), self.places[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.places[at] >= 0))
        for _ in range(self.reach):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            place = self.places[at[open_]]
            hit = (place >= 0) & (self.slots[at[open_]] == keys[open_])
            out[open_[hit]] = place[hit]
            open_ = open_[~hit & (place >= 0)]
        return out
