"""Connected components of near duplicates found through shared tokens, without all pairs of a list.

Nodes that look alike beforehand form groups; a group's least node is its head, and only heads have
tokens. Every node is verified against its head and every head against a few others first. What is
then connected needs no further pair. Lists that still hold several large pieces are verified against a few of
their rows, round after round. Of the pairs left, those that share a token, fit and lie in
different components are expanded to their members and verified, all of them.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.llm.components import components
from skillgauge.sources.stores import stage

ID_BITS = 23


def id_cell(name: str) -> Column:
    """The bitmap cell of an id."""
    return F.shiftrightunsigned(F.xxhash64(name), 64 - ID_BITS)


def id_bitmap(cells: DataFrame):
    """Broadcast bitmap (1 MB at any size) of the values of a column of cells."""
    words = cells.toDF("c").groupBy(F.shiftright("c", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(c & 7 as int))")).alias("bits"))
    bitmap = np.zeros(1 << (ID_BITS - 3), dtype=np.uint8)
    for byte, bits in words.collect():  # at most 2**20 rows, as the bitmap is
        bitmap[byte] = bits
    return cells.sparkSession.sparkContext.broadcast(bitmap.tobytes())


def in_bitmap(shared, cells: np.ndarray) -> np.ndarray:
    known = np.frombuffer(shared.value, dtype=np.uint8)
    return (known[cells >> 3] >> (cells & 7)) & 1 == 1


def pack(body: bytes) -> bytes:
    return zstandard.compress(body, 1)


def unpack(batch, name: str) -> list[bytes]:
    return [zstandard.decompress(b) for b in batch.column(name).to_pylist()]


def _keep_known(shared):
    def run(batches):
        for batch in batches:
            near = batch.filter(pa.array(in_bitmap(shared, np.asarray(batch.column("cell")))))
            yield pa.RecordBatch.from_arrays([near.column("id"), pa.array([pack(b or b"") for b in near.column("body").to_pylist()], pa.binary())], names=["id", "body"])

    return run


def bodies_of(table: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Finds the rows of ``table`` (id, body) whose id is among ids (id), with packed bodies, without shuffling
    the others: a bitmap of fixed size drops them at the scan, but for a few that collide."""
    def find(ids: DataFrame) -> DataFrame:
        known = id_bitmap(ids.select(id_cell("id")))
        near = table.where(F.col("id").isNotNull()).withColumn("cell", id_cell("id"))
        return near.mapInArrow(_keep_known(known), "id long, body binary")

    return find


def with_bodies(find: Callable[[DataFrame], DataFrame], pairs: DataFrame, name: str, per_task: int | None = None) -> DataFrame:
    """Pairs (a, b) with both packed bodies, body_a and body_b. ``find`` gives (id, body) of wanted ids.

    Pairs grow with the corpus, so the joins sort and merge at every size. With ``per_task`` pairs are dealt out evenly to as many
    tasks as a shuffle has, fewer if there are not that many pairs for each."""
    pairs = stage(pairs, f"{name}-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    found = stage(find(ids), f"{name}-bodies")
    one = pairs.join(found.select(F.col("id").alias("a"), F.col("body").alias("body_a")).hint("merge"), "a")
    both = one.join(found.select(F.col("id").alias("b"), F.col("body").alias("body_b")).hint("merge"), "b")
    if per_task is None:
        return both
    return both.repartition(min(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs.count() // per_task + 1))


_PIVOTS = 4
_CROWDED = 8  # so many pairs a row are left to the join of all pairs


def _crowded(rows: DataFrame) -> int:
    """How many pairs of ``rows`` share a token and are not all of one component, at most; 0 if not many more than the rows."""
    owned = rows.groupBy("token", "low", "high").agg(F.count(F.lit(1)).cast("double").alias("k"))
    lists = owned.groupBy("token").agg(F.sum("k").alias("n"), F.sum(F.when(F.col("low") == F.col("high"), F.col("k") * F.col("k")).otherwise(0)).alias("one"))
    n, pairs = lists.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("one")) / 2)).first()
    return int(pairs) if n and pairs > _CROWDED * n else 0


def _to_pivots(rows: DataFrame, number: int, apart: Column, fits: Callable[[DataFrame, DataFrame], Column]) -> DataFrame:
    """Pairs of heads (a, b): each row with some rows of its token, others in each round ``number``. No more pairs than rows times pivots."""
    row = F.struct(*rows.columns)
    some = [F.min_by(row, F.xxhash64("head", F.lit(number * _PIVOTS + k))) for k in range(_PIVOTS)]
    pivots = rows.groupBy("token").agg(*[x.alias(f"p{k}") for k, x in enumerate(some)])
    pivots = pivots.select(F.explode(F.array_distinct(F.array(*[f"p{k}" for k in range(_PIVOTS)]))).alias("row")).select("row.*")
    x, y = rows.alias("x"), pivots.alias("y")
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.head") != F.col("y.head")) & apart & fits(x, y))
    return pairs.select(F.greatest("x.head", "y.head").alias("a"), F.least("x.head", "y.head").alias("b")).distinct()


def link_groups(
    members: DataFrame, tokens: DataFrame, near: DataFrame, fits: Callable[[DataFrame, DataFrame], Column],
    verify: Callable[[DataFrame, str], DataFrame], once: Callable[[DataFrame, DataFrame], Column] | None = None,
) -> DataFrame:
    """(node, component) of all nodes with a link.

    ``members`` are (node, head), ``tokens`` (head, token, ...) of tokens that several heads share,
    ``near`` pairs of heads (a, b) to look at first. ``fits`` tells from two token rows whether their groups
    may link, ``once`` whether a pair is to be taken from this token rather than another it shares;
    ``verify`` keeps the pairs (a, b) that do.

    While far more pairs than rows are left, the rows of a token are verified against a few of them, which joins what a
    large group of near copies has in pieces; a round that joins little is the last.
    """
    looks = members.where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    links = verify(looks.union(near.select("a", "b")), "first")
    apart = (F.col("x.low") != F.col("y.high")) | (F.col("x.high") != F.col("y.low"))
    number, before = 0, float("inf")
    while True:
        labels = components(links, "a", "b")
        labelled = stage(members.join(labels, "node", "left").select("node", "head", F.coalesce("component", "node").alias("label")), "labelled")
        spread = labelled.groupBy("head").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        tagged = stage(tokens.join(spread, "head"), "tagged")
        mixed = tagged.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most")).where("least < most")
        left = stage(tagged.join(mixed.select("token"), "token", "left_semi"), "mixed")
        crowd = _crowded(left)
        if not crowd or crowd > 0.8 * before:
            break
        more = verify(_to_pivots(left, number, apart, fits), f"round-{number}")
        if more.isEmpty():
            break
        links, number, before = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), number + 1, crowd
        tokens = left.drop("low", "high")  # a token whose rows are in one component stays so
    x, y = left.alias("x"), left.alias("y")
    meets = fits(x, y) & once(x, y) if once else fits(x, y)
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.head") < F.col("y.head")) & apart & meets)
    groups = pairs.select(F.col("x.head").alias("g"), F.col("y.head").alias("h")).distinct()
    groups = groups.union(spread.where("low < high").select(F.col("head").alias("g"), F.col("head").alias("h")))
    one = labelled.select(F.col("head").alias("g"), F.col("node").alias("a"), F.col("label").alias("la"))
    two = labelled.select(F.col("head").alias("h"), F.col("node").alias("b"), F.col("label").alias("lb"))
    rest = groups.join(one, "g").join(two, "h").where(F.col("la") != F.col("lb"))
    rest = stage(rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "rest")
    if rest.isEmpty():
        return labels
    more = verify(rest, "rest")
    # Nothing new to connect: the components stand.
    return labels if more.isEmpty() else components(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "a", "b")
