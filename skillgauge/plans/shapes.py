"""Prediction, truth and registry shapes derived from the driver tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy frame over the whole table. The
matching DuckDB definitions are in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillgauge.schema import EXPERIMENT, SETTINGS, TARGETS

# Models of the derived experiments and the factor applied to their error.
# ``lr`` has two strategies, so that the choice of the baseline row matters.
MODEL_FACTORS = [
    ("lr", "mean", 1.0), ("lr", "max", 1.05), ("xgb", "mean", 0.8),
    ("ridge", "mean", 1.1), ("constant", "mean", 1.5),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    """The value at ``index`` modulo the list length."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def setting_of(index: Column) -> Column:
    return pick(SETTINGS, index)


def target_of(index: Column) -> Column:
    return pick(TARGETS, index)


def experiments(*rows: tuple[str, str, float]) -> Column:
    """Generator of (val_strategy, model, factor) per listed (model, val_strategy, factor)."""
    return F.inline(F.array(*[
        F.struct(F.lit(strategy).alias("val_strategy"), F.lit(model).alias("model"), F.lit(factor).alias("factor"))
        for model, strategy, factor in rows
    ]))


def pred_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as sites; one experiment."""
    return table(spark, sf_dir, "events").select("*", experiments(("lr", "mean", 1.0))).select(
        F.lit("time-split").alias("setting"), F.lit("GPP").alias("target"), "model", "val_strategy",
        F.col("event_type").alias("env"), F.col("event_type").alias("site_id"),
        F.col("ts").alias("time"), F.col("value").alias("y_true"),
        (F.col("value") * 0.8 + F.pmod("event_id", F.lit(11))).alias("y_pred"),
    )


def _lineitem_series(spark: SparkSession, sf_dir: str, setting: Column, target: Column, *rows: tuple[str, str, float]) -> DataFrame:
    y_true = F.col("l_quantity")
    y_pred = 0.9 * F.col("l_quantity") + 0.5 * F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select("*", experiments(*rows)).select(
        setting.alias("setting"), target.alias("target"), "model", "val_strategy",
        F.concat("l_returnflag", F.lit("-"), F.year("l_shipdate")).alias("env"),
        F.col("l_returnflag").alias("site_id"),
        F.col("l_shipdate").alias("time"), y_true.alias("y_true"),
        (y_true + F.col("factor") * (y_pred - y_true)).alias("y_pred"),
    )


def pred_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return flags as sites, site-years as reporting groups, seven years of days."""
    return _lineitem_series(spark, sf_dir, F.lit("time-split"), F.lit("GPP"), ("lr", "mean", 1.0))


def pred_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models in three settings and targets; each model scales the error of the base series."""
    return _lineitem_series(spark, sf_dir, setting_of(F.col("l_suppkey")), target_of(F.col("l_partkey")), *MODEL_FACTORS)


def pred_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two experiments on the same series: one already daily, one with many rows per day."""
    raw = pred_lineitem(spark, sf_dir)
    single = raw.groupBy("setting", "target", "val_strategy", "env", "site_id", F.col("time").cast("date").alias("d")).agg(
        F.min("y_true").alias("y_true"), F.min("y_pred").alias("y_pred"),
    ).select(
        "setting", "target", F.lit("daily").alias("model"), "val_strategy", "env", "site_id",
        (F.col("d").cast("timestamp_ntz") + F.expr("INTERVAL 6 HOURS")).alias("time"), "y_true", "y_pred",
    )
    return raw.withColumn("model", F.lit("hourly")).unionByName(single)


def truth_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as sites; (user, ts) is unique."""
    return table(spark, sf_dir, "events").select(
        setting_of(F.col("event_id")).alias("setting"), target_of(F.floor(F.col("event_id") / 3)).alias("target"),
        F.col("user_id").cast("string").alias("site_id"), F.col("ts").alias("time"),
        F.col("value").alias("y_true"),
    )


def sub_events(spark: SparkSession, sf_dir: str, outlier: float = 1e12) -> DataFrame:
    """Submissions over the events truth: one clean model and one per kind of tampering.

    ``outlier`` is the large prediction of the broken model, over the magnitude cap by default.
    """
    eid, kind = F.col("event_id"), F.col("kind")
    # (model, kind of its rows); the last two add rows to a model.
    variants = F.inline(F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(k).alias("kind"), F.lit("mean").alias("val_strategy"))
        for m, k in [("clean", ""), ("short", "short"), ("late", ""), ("shifted", "shifted"), ("broken", "broken"),
                     ("copied", ""), ("late", "old"), ("copied", "again")]
    ]))
    rows = table(spark, sf_dir, "events").select("*", variants).where(
        F.when(kind == "short", eid % 97 != 0).when(kind == "old", eid % 1009 == 0).when(kind == "again", eid % 701 == 0)
        .otherwise(F.lit(True))
    )
    y_pred = F.col("value") * 0.8 + F.pmod(eid, F.lit(11))
    spoiled = (
        F.when(eid % 503 == 0, F.lit(float("nan"))).when(eid % 509 == 0, F.lit(float("inf")))
        .when(eid % 521 == 0, F.lit(outlier)).otherwise(y_pred)
    )
    site = F.col("user_id").cast("string")
    return rows.select(
        setting_of(eid).alias("setting"), target_of(F.floor(eid / 3)).alias("target"), "model", "val_strategy", site.alias("env"), site.alias("site_id"),
        F.when(kind == "old", F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("time"),
        F.when((kind == "shifted") & (eid % 89 == 0), F.col("value") + 5).otherwise(F.col("value")).alias("y_true"),
        F.when(kind == "broken", spoiled).otherwise(y_pred).alias("y_pred"),
    )


def quota_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("call_id"), F.col("user_id").alias("client"), F.col("ts").alias("time"),
    )


def order_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file catalogue: one file per order, grouped into one submission per customer."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    setting = setting_of(key)
    target = pick(TARGETS, F.floor(key / 3))
    model = F.concat(F.lit("m_"), cust)
    name = F.concat(setting, F.lit("_"), target, F.lit("_"), model, F.lit("_val_mean_predictions.csv"))
    spoiled = (
        F.when(key % 41 == 0, F.concat(F.lit("notes-"), key, F.lit(".csv")))
        .when(key % 43 == 0, F.replace(name, F.lit("_m_"), F.lit("_other_")))
        .when(key % 47 == 0, F.replace(name, F.lit("_val_mean"), F.lit("_val_max")))
        .otherwise(name)
    )
    return table(spark, sf_dir, "orders").select(
        model.alias("model_id"), F.lit("mean").alias("val_strategy"),
        F.concat(F.lit("incoming/"), F.lpad(key.cast("string"), 12, "0"), F.lit("/"), spoiled).alias("path"),
        spoiled.alias("filename"),
        F.floor(F.col("o_totalprice") * 1000).cast("long").alias("bytes"),
    )


def _event_file_name() -> Column:
    return F.concat_ws("_", "setting", "target", "model", F.lit("val"), F.concat("val_strategy", F.lit("_predictions.csv")))


def sub_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sub_events`` as rows of files. The file of one combo of ``late`` lost all its rows, one of ``copied``
    has a second file with the same rows, and faulty truth values are spread over ``shifted``."""
    rows = sub_events(spark, sf_dir).withColumn("path", _event_file_name())
    combo = (F.col("setting") == "TA40") & (F.col("target") == "GPP")
    rows = rows.where(~((F.col("model") == "late") & combo))
    paths = F.when((F.col("model") == "copied") & combo, F.array("path", F.concat(F.lit("second/"), "path"))).otherwise(F.array("path"))
    faulty = (F.col("model") == "shifted") & (F.col("setting") == "TA40")
    y_true = (
        F.when(faulty & (F.col("target") == "GPP"), F.lit(float("nan"))).when(faulty & (F.col("target") == "ET"), F.lit(None))
        .when(faulty & (F.col("target") == "NEE"), F.lit(float("inf"))).otherwise(F.col("y_true"))
    )
    return rows.withColumn("path", F.explode(paths)).withColumn("y_true", y_true)


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File catalogue of ``sub_event_rows``: one file per experiment, 100 bytes per row, and two more for
    ``copied``: a second file of a combo and a file named for ``clean``."""
    listed = sub_events(spark, sf_dir).groupBy(*EXPERIMENT).agg((F.count(F.lit(1)) * 100).alias("bytes")).withColumn("filename", _event_file_name())
    more = (F.col("model") == "copied") & (F.col("setting") == "TA40") & (F.col("target") == "GPP")
    own = F.struct(F.col("filename").alias("path"), F.col("filename").alias("filename"))
    second = F.struct(F.concat(F.lit("second/"), "filename").alias("path"), F.col("filename").alias("filename"))
    other = F.replace(F.col("filename"), F.lit("copied"), F.lit("clean"))
    strange = F.struct(F.concat(F.lit("strange/"), other).alias("path"), other.alias("filename"))
    files = F.explode(F.when(more, F.array(own, second, strange)).otherwise(F.array(own)))
    return listed.withColumn("file", files).select(
        F.col("model").alias("model_id"), "val_strategy", "file.filename", "bytes", "file.path")


def unreadable_event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of ``short`` that could not be parsed."""
    listed = sub_events(spark, sf_dir).where("model = 'short' and setting = 'TA40' and target <> 'NEE'").select(*EXPERIMENT).distinct()
    return listed.select(_event_file_name().alias("path"), F.lit("missing columns time").alias("problem"))


def owner_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per customer; every fifth names no owner."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("m_"), key).alias("model_id"), F.lit("mean").alias("val_strategy"),
        F.when(key % 5 != 0, F.col("c_name")).alias("owner"),
    )


def owner_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded owners: a third agrees with the claim, a third differs, a third is unknown."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(key % 3 != 2).select(
        F.concat(F.lit("m_"), key).alias("model_id"),
        F.when(key % 3 == 0, F.col("c_name")).otherwise("someone else").alias("recorded_owner"),
    )


def registry_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document per customer, three strategies per model, with assorted defects."""
    key = F.col("c_custkey")
    strategy = pick(["mean", "max", "discrepancy"], key)
    model = F.concat(F.lit("m_"), F.floor(key / 3))
    status = F.when(key % 13 == 0, "scored").when(key % 17 == 0, "draft").otherwise("pending")
    folder = F.concat(model, F.lit("_val_"), strategy)
    text = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('",'))
    file_key = F.concat(F.lit("incoming/"), folder, F.lit("/file_"))
    entry = lambda n: F.concat(
        F.lit('{"filename":"file_'), F.lit(n), F.lit('","setting":"TA40"'),
        F.when(key % 23 == 0, "").otherwise(',"target":"GPP"'),
        F.when(key % 29 == 0, "").otherwise(F.concat(F.lit(',"r2_key":"'), file_key, F.lit(n), F.lit('"'))),
        F.lit("}"),
    )
    doc = F.concat(
        F.lit("{"), text("model_id", model), text("display_name", F.col("c_name")),
        F.when(key % 7 == 0, "").otherwise('"email":null,'),
        F.lit('"description":null,"code_url":null,"paper_url":null,'),
        text("owner", F.col("c_name")), text("val_strategy", strategy),
        F.when(key % 11 == 0, "").otherwise('"submitted_at":"2024-01-01",'),
        F.lit('"is_baseline":false,'), text("status", status),
        F.lit('"files":['),
        F.when(key % 19 == 0, "").otherwise(F.concat(entry("0"), F.lit(","), entry("1"))),
        F.lit("]}"),
    )
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("submissions/"), folder, F.lit("/metadata.json")).alias("path"), doc.alias("doc")
    )


def event_registry_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole document per model of ``sub_events``, with its files. ``late`` lacks a field, ``copied`` is a draft and
    one object of ``shifted`` was never stored (``event_objects``)."""
    model, files = F.col("model"), F.array_sort(F.collect_list(F.struct(
        _event_file_name().alias("filename"), "setting", "target", F.concat(F.lit("incoming/"), _event_file_name()).alias("r2_key"))))
    listed = sub_events(spark, sf_dir).select(*EXPERIMENT).distinct().groupBy("model", "val_strategy").agg(files.alias("files"))  # nine files at most
    owner = F.when(model != "short", F.sha2(model.cast("binary"), 256))
    nothing = F.lit(None).cast("string")
    fields = [
        model.alias("model_id"), model.alias("display_name"), *[nothing.alias(c) for c in ("description", "code_url", "paper_url")],
        owner.alias("owner"), "val_strategy", F.lit("2024-01-01").alias("submitted_at"), F.lit(False).alias("is_baseline"),
        F.when(model == "copied", "draft").otherwise("pending").alias("status"), "files",
    ]
    whole = lambda *more: F.to_json(F.struct(*more, *fields), {"ignoreNullFields": "false"})
    doc = F.when(model == "late", whole()).otherwise(whole(nothing.alias("email")))
    return listed.select(F.concat(F.lit("submissions/"), model, F.lit("/metadata.json")).alias("path"), doc.alias("doc"))


def event_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = sub_events(spark, sf_dir).select(*EXPERIMENT).distinct()
    lost = (F.col("model") == "shifted") & (F.col("setting") == "TA40") & (F.col("target") == "NEE")
    return listed.where(~lost).select(F.concat(F.lit("incoming/"), _event_file_name()).alias("path"))


def stored_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys present in storage: both files of a submission, unless lost."""
    key = F.col("c_custkey")
    folder = F.concat(
        F.lit("incoming/m_"), F.floor(key / 3), F.lit("_val_"), pick(["mean", "max", "discrepancy"], key), F.lit("/file_")
    )
    numbers = F.when(key % 31 == 0, F.array(F.lit("0"))).when(key % 37 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.lit("0"), F.lit("1")))
    return table(spark, sf_dir, "customer").select(folder.alias("folder"), F.explode(numbers).alias("n")).select(
        F.concat("folder", "n").alias("path")
    )


def model_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display labels of the derived models, named after nations; one holds for every strategy."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.when(key == 0, "xgb").when(key == 1, "ridge").when(key == 2, "lr").otherwise(F.concat(F.lit("m_"), key)).alias("model_id"),
        F.when(key != 2, "mean").alias("val_strategy"),
        F.col("n_name").alias("display_name"),
        F.when(key == 0, "cv-mean").otherwise("").alias("val_strategy_display"),
    )


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sub_events`` with an outlier that keeps six decimals of the metrics meaningful."""
    return sub_events(spark, sf_dir, outlier=1000.0)
