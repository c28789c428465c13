"""Token rollup: batches that come after a compaction past their number."""

from pyspark.sql import functions as F

from skillgauge.llm import token_rollup
from tests.llm.test_table_operators import CHANGES, amounts


def test_late_batches_below_the_mark_count_once(spark, tmp_path):
    one = lambda source, n: spark.createDataFrame([("insert", source, "en", "v1", n, None)], CHANGES)
    rollup = token_rollup.Rollup(spark, str(tmp_path / "store"))
    rollup.commit(0, one("a", 10))
    rollup.commit(2, one("a", 5))
    rollup.commit(3, one("a", 1).where(F.lit(False)))
    rollup.compact(3)
    rollup.commit(1, one("b", 7))
    expected = {("a", "en", "v1"): (2, 15), ("b", "en", "v1"): (1, 7)}
    assert amounts(rollup) == expected
    for batch in (0, 2, 3):
        rollup.commit(batch, one("c", 100))  # folded: a replay changes nothing
    rollup.commit(1, one("b", 7))
    assert amounts(rollup) == expected
    rollup.commit(4, one("d", 1))
    rollup.compact(4)
    rollup.commit(1, one("b", 9))
    assert amounts(token_rollup.Rollup(spark, str(tmp_path / "store"))) == expected | {("d", "en", "v1"): (1, 1)}
