"""Token counts as delta-maintained rollups.

A store holds totals of documents and tokens by source, language and tokenizer version. A batch of
changes (inserts, deletes, revised counts) becomes signed amounts, summed per key before they are
written as the batch's delta. Totals are sums of deltas, so batches may arrive in any order, and a
batch committed twice replaces its own delta and counts once. ``compact`` folds the deltas up to a
batch into a snapshot and records which batches it folded; later replays of these change nothing, and a
batch of a lower number that comes later still counts.

Sums are combined per task, so a source with a third of all rows is no hot key. Nothing is
collected; a store's files live in the shared folder.

Defined cases: null sources and languages are keys of their own. A null or empty text has no tokens
but is a document. Null counts are zero. Rows that repeat are separate changes. A key whose
documents and tokens are both back to zero is not listed. An empty batch is a delta that adds nothing.
Columns other than the named ones are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.session import shared_folder
from skillgauge.sources.stores import stage

KEYS = ["source", "lang", "version"]
_AMOUNTS = "source string, lang string, version string, docs long, tokens long"
_DELTA = f"{_AMOUNTS}, batch long"
_FOLD = "batch long, mark long"

# Tokenizer versions of the registered query: name and the pattern of one token.
VERSIONS = {"spaced-1": r"[^\x20\x09-\x0D]+", "alnum-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"}


def signed(changes: DataFrame) -> DataFrame:
    """(source, lang, version, docs, tokens) amounts of changes (op, source, lang, version, n_tokens,
    old_tokens); ``op`` is insert, delete or revise."""
    op, new, old = F.col("op"), F.coalesce(F.col("n_tokens"), F.lit(0)), F.coalesce(F.col("old_tokens"), F.lit(0))
    sign = F.when(op == "insert", 1).when(op == "delete", -1).otherwise(0)
    return changes.where(op.isin("insert", "delete", "revise")).select(
        *KEYS, sign.cast("long").alias("docs"), F.when(op == "revise", new - old).otherwise(sign * new).cast("long").alias("tokens"))


def _summed(amounts: DataFrame) -> DataFrame:
    return amounts.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """A rollup store in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        # Folders and the mark "nothing folded" exist from the start; writing them again changes nothing.
        for name in ("deltas", "snapshots"):
            self._write(spark.createDataFrame([], _AMOUNTS), name, -1)
        spark.createDataFrame([], _FOLD).write.mode("overwrite").parquet(f"{self.path}/folds/n=-1")
        self._write(self._zero(), "marks", -1)

    def _zero(self) -> DataFrame:
        """One row that adds nothing: a batch or mark is there even without amounts."""
        return self.spark.createDataFrame([(None, None, None, 0, 0)], _AMOUNTS)

    def _write(self, amounts: DataFrame, name: str, batch: int) -> None:
        """Replace one batch; the folder is named after it, so a retry replaces its own files only."""
        amounts.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{self.path}/{name}/n={batch}")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_DELTA).option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}")

    def _folded(self) -> int:
        """The last batch compacted up to, -1 before the first."""
        return self._read("marks").agg(F.max("batch")).first()[0]

    def _read_folds(self) -> DataFrame:
        return self.spark.read.schema(_FOLD).option("recursiveFileLookup", "true").parquet(f"{self.path}/folds")

    def _folds(self) -> DataFrame:
        """(batch, mark) of each batch in a snapshot that counts: those folded under a mark that was written."""
        return self._read_folds().where(F.col("mark") <= self._folded())

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Apply a batch; committing it again replaces its amounts, or changes nothing once it is folded."""
        if self._folds().where(F.col("batch") == batch).isEmpty():
            self._write(_summed(signed(changes).unionByName(self._zero())), "deltas", batch)

    def compact(self, batch: int) -> None:
        """Fold all deltas up to ``batch`` into a snapshot; the mark written last makes it count."""
        if batch <= self._folded():
            return
        fresh = self._fresh().where(F.col("batch") <= batch)
        fresh.select("batch", F.lit(batch).cast("long").alias("mark")).distinct().write.mode("overwrite").parquet(f"{self.path}/folds/n={batch}")
        listed = self._read_folds().where(F.col("mark") == batch).select("batch")
        self._write(self._current(fresh.join(listed, "batch", "left_semi")), "snapshots", batch)
        self._write(self._zero(), "marks", batch)

    def _fresh(self) -> DataFrame:
        """Deltas in no snapshot yet, whatever their number."""
        return self._read("deltas").join(self._folds().select("batch"), "batch", "left_anti")

    def _current(self, fresh: DataFrame) -> DataFrame:
        return _summed(self._read("snapshots").where(F.col("batch") == self._folded()).unionByName(fresh))

    def totals(self) -> DataFrame:
        return self._current(self._fresh()).where("docs != 0 or tokens != 0")


def n_tokens(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("long")


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """All documents are inserted with a count estimated from their length, every count is then revised
    to the exact one (a batch delivered twice), and documents labelled toxic are deleted."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    counted = stage(docs.select(
        "doc_id", "source", "lang", F.coalesce(F.floor(F.col("n_chars") / 4), F.lit(0)).cast("long").alias("guess"),
        F.explode(F.array(*[F.struct(F.lit(name).alias("version"), n_tokens(F.col("text"), p).alias("n")) for name, p in VERSIONS.items()])).alias("t"),
    ).select("doc_id", "source", "lang", "guess", "t.version", "t.n"), "token-counts")
    keyed = lambda df, op, new, old: df.select(*KEYS, F.lit(op).alias("op"), new.alias("n_tokens"), old.cast("long").alias("old_tokens"))
    toxic = labels.where("toxic = 1").select("doc_id").distinct()
    rollup = Rollup(spark, f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}")
    none = F.lit(None)
    revised = keyed(counted, "revise", F.col("n"), F.col("guess"))
    rollup.commit(0, keyed(counted, "insert", F.col("guess"), none))
    rollup.commit(1, revised)
    rollup.compact(0)
    rollup.commit(2, keyed(counted.join(toxic, "doc_id", "left_semi"), "delete", F.col("n"), none))
    rollup.commit(1, revised)
    return rollup.totals()


ORACLE = r"""
WITH counted AS (
  SELECT doc_id, source, lang, 'spaced-1' AS version, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n FROM documents
  UNION ALL
  SELECT doc_id, source, lang, 'alnum-1', coalesce(len(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')), 0) FROM documents
)
SELECT source, lang, version, CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS tokens
FROM counted WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
GROUP BY ALL
"""
