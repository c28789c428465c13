"""Prefix trie of conversations as a burst trie: a few heads above many small containers.

A conversation is a sequence of turns; every distinct sequence of first d turns is a node at depth d. Turns
get ids (128-bit hashes of role and text), so texts take no part after the first step, and conversations
with equal sequences are taken together with their count, least id and a digest of all ids.

All sequences start in one container under the root. A container of more than ``LIMIT`` distinct sequences
bursts: it becomes a head, and its sequences fall into a container for each next turn id. So it goes on,
one Spark step a level, for the containers that are too large; there are as many steps as the deepest head lies
deep. The other containers are dealt out by their head's key, sorted by sequence and swept: neighbours share the
nodes above their common prefix, and a stack holds the open ones. A task holds one container of nodes at a time.
Heads are aggregated from their sequences, and sums over their subtrees from the containers below.

Digests of conversation ids are SHA-256 over one ordered list, so a node's are hashed one after the other: ids are
joined to texts by ranges of ``_CHUNK`` ids first, and a task hashes those in order, never holding a whole list.

Defined cases: turns are ordered by ``turn`` (null first), then role and text; repeated rows are repeated turns.
A null role or text is empty. Rows without a ``conv_id`` belong to no conversation. An empty table has no
nodes. One conversation is held whole by one task, as a text is. Columns other than conv_id, turn, role and text,
whatever their names, are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillgauge.llm import words as W
from skillgauge.sources.stores import stage

LIMIT = 1024
_CHUNK = 4096
_FLUSH = 1 << 15
_HEAD = "struct<a: bigint, b: bigint>"
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
_NOTHING = hashlib.sha256(b"").digest()


def _id(*parts: Column | str) -> Column:
    """A 128-bit id of values."""
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *parts).alias("b"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns) of a table of turns; each turn is its id (a, b) and how many code points its text has."""
    own = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    turn = F.struct("turn", "role", "text", _id("role", "text").alias("id"), F.char_length("text").cast("long").alias("chars"))
    ordered = own.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return ordered.select("conv_id", F.expr("transform(turns, t -> named_struct('a', t.id.a, 'b', t.id.b, 'chars', t.chars))").alias("turns"))


def _digest(batches):
    """SHA-256 of each key's texts, comma-joined; rows come by key, in order."""
    key = state = None
    for batch in batches:
        done = []
        for a, b, text in zip(*(batch.column(c).to_pylist() for c in ("ka", "kb", "ids"))):
            if (a, b) != key:
                if key is not None:
                    done.append((*key, state.digest()))
                key, state = (a, b), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.binary()))], names=["ka", "kb", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([state.digest()], pa.binary())], names=["ka", "kb", "ends"])


def distinct_sequences(conversations: DataFrame) -> DataFrame:
    """(turns, n, least, ends) of the distinct sequences of (conv_id, turns): how many conversations have it, the
    least id, and the digest of all ids."""
    keyed = conversations.select("conv_id", "turns", _id("turns").alias("k")).select("conv_id", "turns", F.col("k.a").alias("ka"), F.col("k.b").alias("kb"))
    keyed = stage(keyed, "sequences")
    listed = keyed.groupBy("ka", "kb", F.floor(F.col("conv_id") / _CHUNK).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    ends = listed.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "chunk").mapInArrow(W.frugal(_digest), "ka long, kb long, ends binary")
    least = keyed.groupBy("ka", "kb").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("turns").alias("turns"))
    return least.join(ends, ["ka", "kb"]).select("turns", "n", "least", "ends")


class _Sweep:
    """Nodes of sorted sequences, container after container, as columns."""

    def __init__(self):
        self.columns = [[] for _ in range(len(_NODE) + 1)]  # and the number of the container for its top node, else -1
        self.heads = []

    def _open(self, depth: int, chars: int, parent: int) -> None:
        self.stack.append(len(self.nodes))
        self.nodes.append([depth, chars, parent, None, 0, 0, 0, 0, None])  # least, n, children, leaves, saved, ends

    def _close(self) -> None:
        node = self.nodes[self.stack.pop()]
        node[6] = node[6] or 1
        node[7] += (node[4] - 1) * node[1]
        if node[2] >= 0:
            above = self.nodes[node[2]]
            above[3] = node[3] if above[3] is None else min(above[3], node[3])
            above[4] += node[4]
            above[5] += 1
            above[6] += node[6]
            above[7] += node[7]

    def begin(self, head, depth: int, chars: int) -> None:
        self.nodes, self.stack, self.last = [], [], None
        self.heads.append(head)
        self._open(depth, chars, -1)

    def add(self, ids: list, chars: list, n: int, least: int, ends: bytes) -> None:
        common = self.nodes[0][0]
        if self.last is not None:
            while common < min(len(ids), len(self.last)) and ids[common] == self.last[common]:
                common += 1
            while self.nodes[self.stack[-1]][0] > common:
                self._close()
        for k in range(common, len(ids)):
            self._open(k + 1, chars[k], self.stack[-1])
        top = self.nodes[self.stack[-1]]
        top[3], top[4], top[8] = least if top[3] is None else min(top[3], least), top[4] + n, ends
        self.last = ids

    def end(self) -> None:
        while self.stack:
            self._close()
        for k, (depth, _, parent, least, n, children, leaves, saved, ends) in enumerate(self.nodes):
            row = (least, depth, None if parent < 0 else self.nodes[parent][3], n, children, leaves, saved, ends or _NOTHING, -1 if k else len(self.heads) - 1)
            for column, value in zip(self.columns, row):
                column.append(value)

    def take(self) -> pa.RecordBatch:
        *columns, top = self.columns
        kinds = [pa.int64()] * 7 + [pa.binary()]
        heads = [self.heads[k] if k >= 0 else (None, None) for k in top]
        self.columns, self.heads = [[] for _ in range(len(_NODE) + 1)], []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)] + [pa.array([h[k] for h in heads], pa.int64()) for k in range(2)], names=[*_NODE, "ha", "hb"])


def _swept(batches):
    """Nodes of containers; rows come by container (ha, hb), then by sequence."""
    sweep, head = _Sweep(), None
    for batch in batches:
        turns, columns = batch.column("turns"), [batch.column(c).to_pylist() for c in ("ha", "hb", "depth", "n", "least", "ends")]
        offsets = np.asarray(turns.offsets).tolist()
        flat = turns.values
        ids = list(zip(flat.field("a").to_pylist(), flat.field("b").to_pylist()))
        chars = flat.field("chars").to_pylist()
        for k, (ha, hb, depth, n, least, ends) in enumerate(zip(*columns)):
            own, sizes = ids[offsets[k] : offsets[k + 1]], chars[offsets[k] : offsets[k + 1]]
            if (ha, hb) != head:
                if head is not None:
                    sweep.end()
                    if len(sweep.columns[0]) >= _FLUSH:
                        yield sweep.take()
                head = (ha, hb)
                sweep.begin(head, depth, sizes[depth - 1] if depth else 0)
            sweep.add(own, sizes, n, least, ends)
    if head is not None:
        sweep.end()
        yield sweep.take()


def _burst(active: DataFrame, depth: int, limit: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """The heads among the containers of one depth, the sequences in other containers, and those that fall into the next depth."""
    large = stage(active.groupBy("head").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > limit).select("head"), "heads")
    if large.isEmpty():
        return None
    last = F.col("turns")[depth - 1]["chars"] if depth else F.lit(0)
    inside = active.join(large, "head", "left_semi")
    child = F.when(F.size("turns") > depth, F.expr(f"named_struct('a', turns[{depth}].a, 'b', turns[{depth}].b)"))
    by_child = inside.withColumn("child", child).groupBy("head", "path", "child").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max(last).alias("chars"), F.max(F.when(F.col("child").isNull(), F.col("ends"))).alias("ends"))
    heads = by_child.groupBy("head", "path").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("chars").cast("long").alias("chars"), F.count("child").alias("children"), F.max("ends").alias("ends"))
    heads = stage(heads.withColumn("depth", F.lit(depth).cast("long")), "head-nodes")
    settled = active.join(large, "head", "left_anti")
    below = inside.where(F.size("turns") > depth).select(
        "turns", "n", "least", "ends", _id("head", F.expr(f"turns[{depth}].a"), F.expr(f"turns[{depth}].b")).alias("head"),
        F.concat("path", F.array("head")).alias("path"), F.lit(depth + 1).cast("long").alias("depth"))
    return heads, settled, stage(below, "burst")


def trie_nodes(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row per node of (conv_id, turns), with ``ends`` the digest of its members of just its depth."""
    spark = conversations.sparkSession
    W.small_batches(spark)
    start = distinct_sequences(conversations).select(
        "turns", "n", "least", "ends", _id(F.lit(0)).alias("head"), F.expr(f"cast(array() as array<{_HEAD}>)").alias("path"), F.lit(0).cast("long").alias("depth"))
    active, settled, heads, depth = stage(start, "distinct-sequences"), [], [], 0
    while (found := _burst(active, depth, limit)) is not None:
        own, small, active = found
        heads.append(own)
        settled.append(small)
        depth += 1
    rows = active
    for small in settled:
        rows = rows.unionByName(small)
    dealt = rows.select("turns", "n", "least", "ends", "depth", F.col("head.a").alias("ha"), F.col("head.b").alias("hb"))
    kinds = ", ".join(f"{c} {'binary' if c == 'ends' else 'long'}" for c in _NODE)
    swept = dealt.repartition("ha", "hb").sortWithinPartitions("ha", "hb", "turns").mapInArrow(W.frugal(_swept), f"{kinds}, ha long, hb long")
    if not heads:
        return swept.select(*_NODE)
    swept = stage(swept, "swept")
    tops = swept.where("ha is not null").withColumn("head", F.struct(F.col("ha").alias("a"), F.col("hb").alias("b")))
    paths = stage(rows.groupBy("head").agg(F.first("path").alias("path")), "paths")
    tops = stage(tops.join(paths, "head").select(*_NODE, "path"), "tops")
    above = heads[0]
    for own in heads[1:]:
        above = above.unionByName(own)
    above = above.withColumn("own", (F.col("n") - 1) * F.col("chars"))
    parts = tops.select(F.explode("path").alias("head"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
    parts = parts.union(above.select(F.explode(F.concat("path", F.array("head"))), F.lit(0).cast("long"), "own"))
    sums = parts.groupBy("head").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    named = stage(above.join(sums, "head").select(
        "head", F.expr("try_element_at(path, -1)").alias("parent"), F.col("least").alias("conv_id"), "depth",
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(_NOTHING)).alias("ends")), "named-heads")
    parents = named.select(F.col("head").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    upper = named.join(parents, "parent", "left").select(*_NODE)
    lower = tops.drop("parent_conv_id").withColumn("parent", F.expr("element_at(path, -1)")).join(parents, "parent").select(*_NODE)
    return swept.where("ha is null").select(*_NODE).unionByName(upper).unionByName(lower)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % 100 instead of its own first h, as the query's
    contract plants them; h = crc32(c) % 6."""
    own = stage(conversations, "own-turns")
    first = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    joined = own.withColumn("base", F.expr("conv_id - conv_id % 100")).join(first, "base", "left")
    joined = joined.withColumn("h", F.expr("cast(crc32(cast(cast(conv_id as string) as binary)) % 6 as int)"))
    return joined.select("conv_id", F.expr("""concat(if(head is null, slice(turns, 1, 0), slice(head, 1, h)),
        slice(turns, h + 1, greatest(size(turns) - h, 0)))""").alias("turns"))


def op13_burst_trie(spark, sf_dir: str) -> DataFrame:
    nodes = trie_nodes(rebuilt(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
    return nodes.select(*[c for c in _NODE if c != "ends"], F.lower(F.hex("ends")).alias("ends_sha256"))


ORACLE = r"""
WITH o AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own, CAST(conv_id AS VARCHAR) AS s
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
k AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(range(1, length(s) + 1), lambda i: [CAST(ascii(substr(s, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 6 AS h FROM o),
q AS (SELECT k.conv_id, list_concat(coalesce(b.own, [])[1 : h], k.own[h + 1 : ]) AS seq FROM k LEFT JOIN o b ON b.conv_id = k.conv_id - k.conv_id % 100),
n AS (
  SELECT d, seq[1 : d] AS p, min(conv_id) AS conv_id, count(*) AS n, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(seq) = d) AS ids
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM q) GROUP BY ALL),
c AS (SELECT d - 1 AS d, p[1 : d - 1] AS p, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
v AS (
  SELECT n.*, coalesce(children, 0) AS children, CASE WHEN children IS NULL THEN 1 ELSE 0 END AS leaf,
    (n.n - 1) * CASE WHEN n.d > 0 THEN length(p[n.d].t) ELSE 0 END AS saved
  FROM n LEFT JOIN c USING (d, p)),
s AS (SELECT a AS d, p[1 : a] AS p, sum(leaf) AS leaves, sum(saved) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM v) GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs, v.children AS n_children, CAST(s.leaves AS BIGINT) AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, sha256(coalesce(v.ids, '')) AS ends_sha256
FROM v JOIN s ON s.d = v.d AND s.p = v.p LEFT JOIN n u ON u.d = v.d - 1 AND u.p = v.p[1 : v.d - 1]
"""
