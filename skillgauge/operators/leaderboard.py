"""Leaderboard tables: cells, wide pivot, skill scores, ranking, labels and colours.

Everything stays long, ``(target, model, val_strategy, setting, scale, value)``, for all targets
at once; the wide form is the last step. ``keys`` of a step are further columns that tell boards apart,
such as ``aggregate``: all boards go through one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skillgauge import schema as sc
from skillgauge.functions import formatting as fmt
from skillgauge.functions.numeric import ratio
from skillgauge.operators.ranking import exact_quantile, exact_quantiles, value_ranks
from skillgauge.sources.stores import stage

ENTRY = ["target", "model", "val_strategy"]
COLUMN = ["setting", "scale"]
QUANTILES = {"median": 0.5, "q90": 0.9}


def leaderboard_metrics(
    metrics: DataFrame,
    settings: Sequence[str] = tuple(sc.SETTINGS),
    dropped: Sequence[str] = tuple(sc.DROPPED_SCALES),
) -> DataFrame:
    """Rows shown on the leaderboard: benchmark settings, shown scales, ``spatial`` as ``site-mean``."""
    return (
        metrics.where(F.col("setting").isin(list(settings)) & ~F.col("scale").isin(list(dropped)))
        .withColumn("scale", F.when(F.col("scale") == "spatial", "site-mean").otherwise(F.col("scale")))
    )


def cells(metrics: DataFrame, metric: str = "rmse", agg: str | Callable[[Column], Column] = "median") -> DataFrame:
    """One value per (entry, setting, scale); cells without a value vanish.

    ``agg`` is ``median``, ``q90``, a quantile ``0 < q < 1`` as text, the name of a built-in
    aggregate, or a function from Column to Column.
    """
    shown = metrics.where(F.col("scale") != "spatial")
    by = [*ENTRY, *COLUMN]
    if isinstance(agg, str) and (agg in QUANTILES or agg.replace(".", "", 1).isdigit()):
        share = QUANTILES[agg] if agg in QUANTILES else float(agg)
        return exact_quantile(shown, by, metric, share, "value")
    build = getattr(F, agg) if isinstance(agg, str) else agg
    return shown.groupBy(*by).agg(build(F.col(metric)).cast("double").alias("value")).where(F.col("value").isNotNull())


def quantile_cells(metrics: DataFrame, metric: str = "rmse", shares: dict[str, float] = QUANTILES) -> DataFrame:
    """The cells of several quantiles from one ranking, told apart by ``aggregate``."""
    return exact_quantiles(metrics.where(F.col("scale") != "spatial"), [*ENTRY, *COLUMN], metric, shares)


def pivot_columns(
    settings: Sequence[str] = tuple(sc.SETTINGS), scales: Sequence[str] = tuple(sc.LEADERBOARD_SCALES),
    extra: Sequence[str] = ("site-mean",),
) -> list[tuple[str, str]]:
    """Column order: settings, then listed scales, then the remaining ones of that setting."""
    return [(s, c) for s in settings for c in [*scales, *extra]]


def living_columns(cells_: DataFrame, columns: Sequence[tuple[str, str]] | None = None, value: str = "value") -> list[tuple[str, str]]:
    """The pairs (setting, scale) in which some entry has a value, in column order: listed pairs first, then others by name.
    There is one row per pair to fetch, however many entries and targets there are."""
    some = {tuple(r) for r in cells_.where(F.col(value).isNotNull()).select("setting", "scale").distinct().toLocalIterator()}
    listed = [p for p in columns or pivot_columns() if p in some]
    return listed + sorted(some - set(listed))


def wide(cells_: DataFrame, columns: Sequence[tuple[str, str]] | None = None, value: str = "value") -> DataFrame:
    """One row per entry with a column ``setting_scale`` per listed pair."""
    pairs = columns or pivot_columns()
    return cells_.groupBy(*ENTRY).agg(*[
        F.max(F.when((F.col("setting") == s) & (F.col("scale") == c), F.col(value))).alias(f"{s}_{c}")
        for s, c in pairs
    ])


def column_facts(cells_: DataFrame, baseline: str = "lr", lower_is_better: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Per (target, setting, scale): the best value and the baseline's value.

    The baseline row of a target is its alphabetically first strategy of the baseline model; a
    column that row lacks has no baseline value. One row per column, whatever the number of
    entries, so the window below holds a handful of rows per target.
    """
    best = F.min if lower_is_better else F.max
    own = F.when(F.col("model") == baseline, F.col("val_strategy"))
    facts = cells_.groupBy(*keys, "target", *COLUMN).agg(
        best("value").alias("best"), F.min(own).alias("strategy"), F.min_by("value", own).alias("own_value"),
    )
    first = F.min("strategy").over(W.partitionBy(*keys, "target"))
    return facts.select(
        *keys, "target", *COLUMN, "best", F.when(F.col("strategy") == first, F.col("own_value")).alias("baseline_value")
    )


def with_facts(cells_: DataFrame, baseline: str = "lr", lower_is_better: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Cells with the best and the baseline value of their column."""
    return cells_.join(column_facts(cells_, baseline, lower_is_better, keys), [*keys, "target", *COLUMN])


def skill_of(value: Column, base: Column) -> Column:
    """``1 - value / base``; NULL without a baseline or when both are 0."""
    return (
        F.when(base != 0, 1 - ratio(value, base))
        .when((base == 0) & (value > 0), F.lit(float("-inf")))
        .when((base == 0) & (value < 0), F.lit(float("inf")))
    )


def _weight(weights: dict[str, float]) -> Column:
    """Weight by scale; scales outside the map weigh 1."""
    known = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.col("scale")), F.lit(1.0))


def overall_of(weights: dict[str, float] | None = None, keys: Sequence[str] = ()) -> Column:
    """Weighted mean skill over the cells an entry has. The window holds one row per column."""
    w = F.when(F.col("skill").isNotNull(), _weight(weights or sc.SCALE_WEIGHTS))
    entry = W.partitionBy(*keys, *ENTRY)
    # Adding 0.0 turns a negative zero into zero, as the ranking does.
    return ratio(F.sum(w * F.col("skill")).over(entry), F.sum(w).over(entry)) + F.lit(0.0)


def skill_scores(
    cells_: DataFrame, baseline: str = "lr", weights: dict[str, float] | None = None, lower_is_better: bool = True,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Per cell: value, best, baseline, skill and the entry's overall score."""
    facts = with_facts(cells_, baseline, lower_is_better, keys)
    return facts.withColumn("skill", skill_of(F.col("value"), F.col("baseline_value"))).withColumn(
        "overall", overall_of(weights, keys)
    )


def relative_to_best(facts: DataFrame, reach: float = 0.2, lower_is_better: bool = True) -> DataFrame:
    """Closeness of each cell to the best of its column, and its colour."""
    share = fmt.closeness(F.col("value"), F.col("best"), reach, lower_is_better)
    return facts.withColumn("closeness", share).withColumn("colour", fmt.colour(F.col("closeness")))


def with_labels(df: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Display labels by (model, val_strategy), else by model alone, else the raw ids.

    ``labels`` is (model_id, val_strategy, display_name, val_strategy_display); a row with a NULL
    strategy holds for every strategy of the model.
    """
    if labels is None:
        return df.withColumn("model_label", F.col("model")).withColumn("strategy_label", F.col("val_strategy"))
    text = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    named = labels.select(
        F.col("model_id").alias("model"), "val_strategy", text("display_name").alias("m"), text("val_strategy_display").alias("s"),
    )
    exact = named.where(F.col("val_strategy").isNotNull()).groupBy("model", "val_strategy").agg(
        F.max("m").alias("m1"), F.max("s").alias("s1"), F.lit(True).alias("listed"))
    loose = named.where(F.col("val_strategy").isNull()).groupBy("model").agg(F.max("m").alias("m2"), F.max("s").alias("s2"))
    listed = F.col("listed").isNotNull()
    return (
        df.join(exact, ["model", "val_strategy"], "left").join(loose, "model", "left")
        .withColumn("model_label", F.coalesce(F.when(listed, F.col("m1")).otherwise(F.col("m2")), F.col("model")))
        .withColumn("strategy_label", F.coalesce(F.when(listed, F.col("s1")).otherwise(F.col("s2")), F.col("val_strategy")))
        .drop("m1", "s1", "m2", "s2", "listed")
    )


def entry_scores(skills: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per entry with its overall score."""
    return skills.groupBy(*keys, *ENTRY).agg(F.max("overall").alias("overall"))


def with_places(skills: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Attach the entry's ``place`` within its target by ``overall``, best first; ties share one.

    An entry without a score has no place and sorts last. Scores are stored first: the same sum
    evaluated twice may differ in its last bit, and an entry would lose its place.
    """
    scores = stage(entry_scores(skills, keys), "entry-scores")
    places = value_ranks(scores, [*keys, "target"], "overall", descending=True).select(
        *keys, "target", "overall", (F.col("first_rank") + 1).alias("place")
    )
    placed = scores.join(places, [*keys, "target", "overall"], "left").select(*keys, *ENTRY, "place")
    return skills.join(placed, [*keys, *ENTRY], "left")


def leaderboard(
    metrics: DataFrame,
    metric: str = "rmse",
    agg: str | Callable[[Column], Column] = "median",
    baseline: str = "lr",
    labels: DataFrame | None = None,
    reach: float = 0.2,
    lower_is_better: bool = True,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Long leaderboard of every target: cells with skill, texts and colour, and the entry's place."""
    if not lower_is_better:
        raise ValueError("the leaderboard assumes that lower metric values are better")
    return _board(cells(metrics, metric, agg), baseline, labels, reach, weights)


def _board(
    cells_: DataFrame, baseline: str, labels: DataFrame | None, reach: float = 0.2, weights: dict[str, float] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """The board of cells that are stored first: one row per entry and column, read by every later step."""
    skills = skill_scores(stage(cells_, "leaderboard-cells"), baseline, weights, keys=keys)
    table = relative_to_best(with_places(skills, keys), reach)
    return with_labels(table, labels).select(
        "target", "place", "model_label", "strategy_label", "model", "val_strategy", "setting", "scale",
        "value", "skill", "overall", "closeness",
        fmt.cell_text(F.col("value"), F.col("target")).alias("value_text"),
        fmt.fixed(F.col("skill"), 2).alias("skill_text"),
        fmt.fixed(F.col("overall"), 2).alias("overall_text"),
        "colour", *keys,
    )


def leaderboard_pages(metrics: DataFrame, metric: str = "rmse", labels: DataFrame | None = None, baseline: str = "lr") -> DataFrame:
    """Median and 90 % leaderboards of every target in one table, from one ranking of the values."""
    return _board(quantile_cells(metrics, metric), baseline, labels, keys=["aggregate"])


def in_model_order(entries: DataFrame, models: Sequence[str]) -> DataFrame:
    """Only the listed models, in that order, per target; an absent one gives an empty row."""
    listed = F.posexplode(F.array(*[F.lit(m) for m in models])).alias("position", "model")
    order = entries.select("target").distinct().select("target", listed)
    return order.join(entries, ["target", "model"], "left")


def setting_label(setting: Column, labels: dict[str, str] | None = None) -> Column:
    known = F.create_map(*[F.lit(x) for pair in (labels or sc.SETTING_LABELS).items() for x in pair])
    return F.coalesce(F.try_element_at(known, setting), setting)
