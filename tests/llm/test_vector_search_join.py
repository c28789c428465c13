"""How packs of queries meet the blocks of vectors."""

import re

import numpy as np
from pyspark.sql import functions as F

from skillgauge.llm.vector_search import top_k


def test_packs_of_queries_are_not_broadcast(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(x) for x in rng.integers(-40, 40, 6)]) for k in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = top_k(vectors, F.col("vec_id") % 10 == 0, k=3, scale=1.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastHashJoin \[ring", plan) and re.search(r"SortMergeJoin \[ring", plan)
    want = set()
    for q, own in rows[::10]:
        scores = sorted((-int(np.dot(own, v)), k) for k, v in rows if k != q)
        want |= {(q, n + 1, k, -s) for n, (s, k) in enumerate(scores[:3])}
    assert {tuple(r) for r in found.collect()} == want
