"""SQL counterparts of the named queries, for checking results on DuckDB.

Every statement reads whole tables. The shapes repeat ``shapes.py``; the rest states the
semantics directly and shares nothing with the Spark operators.
"""

from __future__ import annotations

from skillgauge.plans.shapes import MODEL_FACTORS

EXP = "setting, target, model, val_strategy"


def _with(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round(({expr}) + 1e-10::DOUBLE, {digits}) + 0.0" + (f" AS {name}" if name else "")


def _pick(values: list[str], index: str) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + f"][CAST(({index}) % {len(values)} AS BIGINT) + 1]"


SETTINGS = ["time-split", "spatial-easy40", "TA40"]
TARGETS = ["GPP", "ET", "NEE"]

# --------------------------------------------------------------------- shapes


def _lineitem(setting: str, target: str, rows: str, name: str) -> str:
    return f"""{name} AS (
  SELECT {setting} AS setting, {target} AS target, m.model, m.strategy AS val_strategy,
         l_returnflag || '-' || CAST(year(l_shipdate) AS VARCHAR) AS env, l_returnflag AS site_id,
         l_shipdate AS "time", l_quantity AS y_true,
         l_quantity + m.f * ((CAST(0.9 AS DOUBLE) * l_quantity + CAST(0.5 AS DOUBLE) * l_linenumber) - l_quantity) AS y_pred
  FROM lineitem CROSS JOIN (VALUES {rows}) m(model, strategy, f))"""


PRED_LINEITEM = _lineitem("'time-split'", "'GPP'", "('lr', 'mean', 1.0::DOUBLE)", "pred")
PRED_MODELS = _lineitem(
    _pick(SETTINGS, "l_suppkey"), _pick(TARGETS, "l_partkey"), ", ".join(f"('{m}', '{s}', {f}::DOUBLE)" for m, s, f in MODEL_FACTORS), "pred")
PRED_EVENTS = """pred AS (
  SELECT 'time-split' AS setting, 'GPP' AS target, 'lr' AS model, 'mean' AS val_strategy, event_type AS env,
         event_type AS site_id, ts AS "time", value AS y_true, value * CAST(0.8 AS DOUBLE) + event_id % 11 AS y_pred FROM events)"""
TRUTH = f"""truth AS (
  SELECT {_pick(SETTINGS, 'event_id')} AS setting, {_pick(TARGETS, '(event_id // 3)')} AS target, CAST(user_id AS VARCHAR) AS site_id, ts AS "time",
         value AS y_true FROM events)"""
_SUB_COLS = (
    f"{_pick(SETTINGS, 'event_id')} AS setting, {_pick(TARGETS, '(event_id // 3)')} AS target, 'mean' AS val_strategy, CAST(user_id AS VARCHAR) AS env, "
    'CAST(user_id AS VARCHAR) AS site_id, ts AS "time", value AS y_true, value * CAST(0.8 AS DOUBLE) + event_id % 11 AS y_pred, event_id')
_SUB = f"""base AS (SELECT {_SUB_COLS} FROM events),
sub AS (
  SELECT 'clean' AS model, * FROM base
  UNION ALL SELECT 'short', * FROM base WHERE event_id % 97 <> 0
  UNION ALL SELECT 'late', * FROM base
  UNION ALL SELECT 'late', * REPLACE (TIMESTAMP '1999-01-01 00:00:00' AS "time") FROM base WHERE event_id % 1009 = 0
  UNION ALL SELECT 'shifted', * REPLACE (CASE WHEN event_id % 89 = 0 THEN y_true + 5 ELSE y_true END AS y_true) FROM base
  UNION ALL SELECT 'broken', * REPLACE (CASE WHEN event_id % 503 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 509 = 0
    THEN 'Infinity'::DOUBLE WHEN event_id % 521 = 0 THEN @BIG ELSE y_pred END AS y_pred) FROM base
  UNION ALL SELECT 'copied', * FROM base
  UNION ALL SELECT 'copied', * FROM base WHERE event_id % 701 = 0)"""
SUB = _SUB.replace("@BIG", "1e12")
SCORED_SUB = _SUB.replace("@BIG", "1000.0")
# Submissions with the canonical truth in place of their own, NaN as NULL.
JOINED = f"""pred AS (
  SELECT s.setting, s.target, s.model, s.val_strategy, s.env, s.site_id, s."time",
         t.y_true, CASE WHEN isnan(s.y_pred) THEN NULL ELSE s.y_pred END AS y_pred
  FROM sub s LEFT JOIN truth t ON s.setting = t.setting AND s.target = t.target AND s.site_id = t.site_id AND s."time" = t."time")"""

# --------------------------------------------------------------------- scales


def _daily(unit: str, k: float, name: str = "daily", src: str = "pred") -> str:
    return f"""{name} AS (
  SELECT *, yt IS NOT NULL AND yp IS NOT NULL AS ok FROM (
    SELECT {EXP}, {unit} AS unit, CAST("time" AS DATE) AS d,
           CASE WHEN count(*) >= {k} THEN avg(y_true) END AS yt, avg(y_pred) AS yp FROM {src} GROUP BY ALL))"""


WEEK, MONTH = "CAST(date_trunc('week', d) AS TIMESTAMP) + INTERVAL 3 DAY", "CAST(date_trunc('month', d) AS TIMESTAMP) + INTERVAL 14 DAY"
YEAR = "make_timestamp(year(d), 7, 1, 0, 0, 0.0)"


def _period(period: str, k: int, src: str, where: str = "", name: str = "t") -> str:
    return f"""SELECT {EXP}, unit, {period} AS {name}, CASE WHEN count(*) FILTER (ok) >= {k} THEN avg(yt) END AS yt, avg(yp) AS yp
  FROM {src} {where} GROUP BY ALL"""


def _anom(k: int, src: str) -> str:
    return f"""SELECT {EXP}, unit, CAST(d AS TIMESTAMP) AS t,
    yt - CASE WHEN count(*) FILTER (ok) OVER w >= {k} THEN avg(yt) FILTER (ok) OVER w END AS yt,
    yp - avg(yp) FILTER (ok) OVER w AS yp
  FROM {src} WINDOW w AS (PARTITION BY {EXP}, unit, dayofyear(d))"""


def _iav(k: int, src: str) -> str:
    return f"""SELECT {EXP}, unit, t, yt - avg(yt) OVER w AS yt, yp - avg(yp) OVER w AS yp
  FROM ({_period(YEAR, k, src, 'WHERE ok')}) WINDOW w AS (PARTITION BY {EXP}, unit)"""


def _spatial(src: str) -> str:
    return f"SELECT {EXP}, unit, avg(yt) AS yt, avg(yp) AS yp FROM ({_period(YEAR, 1, src, 'WHERE ok')}) GROUP BY ALL"


def _seasonal(k: int, src: str) -> str:
    return f"""SELECT {EXP}, unit, dayofyear(d) AS doy, CASE WHEN count(*) >= {k} THEN avg(yt) END AS yt, avg(yp) AS yp
  FROM {src} WHERE ok GROUP BY ALL"""


def _out(src: str, unit: str, extra: str | None = '"time"', t: str = "t") -> str:
    when = f"{t} AS {extra}, " if extra else ""
    return f"SELECT {EXP}, unit AS {unit}, {when}{_r('yt', 'y_true')}, {_r('yp', 'y_pred')} FROM ({src})"


# --------------------------------------------------------------------- metrics

_FIN = "isfinite(yt) AND isfinite(yp)"
_MEAN = f"abs(avg(yt) FILTER ({_FIN})) > 1e-9 * (avg(abs(yt)) FILTER ({_FIN}))"
METRIC_SQL = {
    "mse": "avg((yp - yt) * (yp - yt))",
    "rmse": "sqrt(avg((yp - yt) * (yp - yt)))",
    "mae": "avg(abs(yp - yt))",
    "nse": f"1 - (avg((yp - yt) * (yp - yt)) FILTER ({_FIN})) / nullif(var_pop(yt) FILTER ({_FIN}), 0)",
    "r2_score": f"pow((covar_pop(yt, yp) FILTER ({_FIN})) / nullif((stddev_pop(yt) FILTER ({_FIN})) * (stddev_pop(yp) FILTER ({_FIN})), 0), 2)",
    "bias": "avg(yt - yp)",
    "relative_mae": f"CASE WHEN {_MEAN} THEN (avg(abs(yp - yt)) FILTER ({_FIN})) / (avg(yt) FILTER ({_FIN})) END",
    "relative_bias": f"CASE WHEN {_MEAN} THEN (avg(yt - yp) FILTER ({_FIN})) / (avg(yt) FILTER ({_FIN})) END",
}


def _metrics(src: str, name: str = "metrics", only: list[str] | None = None) -> str:
    cols = ", ".join(f"{METRIC_SQL[m]} AS {m}" for m in (only or METRIC_SQL))
    return f"""{name} AS (
  SELECT target, setting, model, val_strategy, scale, env, count(*) AS n_samples, {cols}
  FROM {src} GROUP BY ALL)"""


METRICS_OUT = "SELECT target, setting, model, val_strategy, scale, env, n_samples, " + ", ".join(
    _r(m, m) for m in METRIC_SQL
) + " FROM metrics"


def _stack(scales: list[str], week: int = 4, month: int = 15, strict_env: str = "TRUE", strict_site: str = "TRUE") -> str:
    source = {
        "hourly": 'SELECT *, env AS unit, y_true AS yt, y_pred AS yp FROM pred',
        "daily": "SELECT * FROM daily_env",
        "weekly": f"SELECT * FROM ({_period(WEEK, week, 'daily_env')}) x WHERE {strict_env}",
        "monthly": f"SELECT * FROM ({_period(MONTH, month, 'daily_env')}) x WHERE {strict_env}",
        "seasonal": f"SELECT * FROM ({_seasonal(2, 'daily_site')}) x WHERE {strict_site}",
        "anom": f"SELECT * FROM ({_anom(2, 'daily_site')}) x WHERE {strict_site}",
        "iav": f"SELECT * FROM ({_iav(183, 'daily_site')}) x WHERE {strict_site}",
        "spatial": f"SELECT * FROM ({_spatial('daily_env')}) x WHERE {strict_env}",
    }
    return "stacked AS (\n" + "\nUNION ALL ".join(
        f"SELECT {EXP}, '{s}' AS scale, unit AS env, yt, yp FROM ({source[s]})" for s in scales) + ")"


ALL_SCALES = ["hourly", "daily", "weekly", "monthly", "seasonal", "anom", "iav", "spatial"]
MODEL_METRICS = [PRED_MODELS, _daily("env", 4, "daily_env"), _daily("site_id", 4, "daily_site"), _stack(ALL_SCALES), _metrics("stacked")]
BOARD = [
    PRED_MODELS, _daily("env", 4, "daily_env"), _daily("site_id", 4, "daily_site"),
    _stack(["hourly", "weekly", "seasonal", "anom", "iav", "spatial"]), _metrics("stacked", "raw_metrics", ["rmse", "nse"]),
    "metrics AS (SELECT * REPLACE (CASE scale WHEN 'spatial' THEN 'site-mean' ELSE scale END AS scale) FROM raw_metrics)",
]


def _cells(q: float | None = 0.5, name: str = "cells") -> str:
    agg = "avg(rmse)" if q is None else f"quantile_cont(rmse, {q})"
    return f"""{name} AS (
  SELECT target, model, val_strategy, setting, scale, {agg} AS value FROM metrics WHERE rmse IS NOT NULL GROUP BY ALL)"""


def _skills(cells: str = "cells", p: str = "") -> list[str]:
    return [
        f"""{p}base AS (
  SELECT c.target, c.setting, c.scale, c.value AS baseline_value FROM {cells} c
  JOIN (SELECT target, min(val_strategy) AS s FROM {cells} WHERE model = 'lr' GROUP BY ALL) f
    ON c.target = f.target AND c.val_strategy = f.s AND c.model = 'lr')""",
        f"""{p}skills AS (
  SELECT c.*, b.baseline_value, 1 - c.value / nullif(b.baseline_value, 0) AS skill,
         min(c.value) OVER (PARTITION BY c.target, c.setting, c.scale) AS best
  FROM {cells} c LEFT JOIN {p}base b ON c.target = b.target AND c.setting = b.setting AND c.scale = b.scale)""",
        f"{p}overall AS (SELECT target, model, val_strategy, avg(skill) AS overall FROM {p}skills GROUP BY ALL)",
    ]


def _closeness(v: str = "value", b: str = "best") -> str:
    return f"CASE WHEN {v} <= {b} THEN 1.0 WHEN {v} >= {b} * 1.2 THEN 0.0 ELSE ({b} * 1.2 - {v}) / ({b} * 1.2 - {b}) END"


_LABELS = """labels AS (
  SELECT coalesce(['xgb', 'ridge', 'lr'][n_nationkey + 1], 'm_' || n_nationkey) AS model, CASE WHEN n_nationkey <> 2 THEN 'mean' END AS s,
         n_name AS display, CASE WHEN n_nationkey = 0 THEN 'cv-mean' END AS sdisplay FROM nation)"""


def _page(agg: str, p: str) -> str:
    return f"""SELECT '{agg}' AS aggregate, k.target, r.place,
    coalesce(CASE WHEN l1.model IS NOT NULL THEN l1.display ELSE l2.display END, k.model) AS model_label,
    coalesce(CASE WHEN l1.model IS NOT NULL THEN l1.sdisplay ELSE l2.sdisplay END, k.val_strategy) AS strategy_label,
    k.model, k.val_strategy, k.setting, k.scale, {_r('k.value', 'value', 4)}, {_r('k.skill', 'skill', 4)}, {_r('r.overall', 'overall', 4)}
  FROM {p}skills k
  JOIN (SELECT *, rank() OVER (PARTITION BY target ORDER BY overall DESC) AS place FROM {p}overall) r
    ON k.target = r.target AND k.model = r.model AND k.val_strategy = r.val_strategy
  LEFT JOIN labels l1 ON l1.model = k.model AND l1.s = k.val_strategy
  LEFT JOIN labels l2 ON l2.model = k.model AND l2.s IS NULL"""


_WIDE_COLUMNS = [(s, c) for s in SETTINGS for c in ["hourly", "daily", "weekly", "monthly", "seasonal", "anom", "iav", "site-mean"]]
_SETTINGS_ORDER = "CASE setting WHEN 'time-split' THEN 1 WHEN 'spatial-easy40' THEN 2 WHEN 'TA40' THEN 3 END"
_MODEL_ORDER = "CASE model WHEN 'xgb' THEN 1 WHEN 'lr' THEN 7 WHEN 'ridge' THEN 9 WHEN 'constant' THEN 10 END"


def _curve(metric: str, order: str, x: str, y: str, names: tuple[str, str]) -> str:
    return f"""SELECT target, setting, scale, model, val_strategy, rn - 1 AS rank, {_r(x, names[0])}, {_r(y, names[1])} FROM (
    SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY target, setting, scale, model, val_strategy) AS n,
           {metric} AS v FROM metrics WHERE {metric} IS NOT NULL
    WINDOW w AS (PARTITION BY target, setting, scale, model, val_strategy ORDER BY {metric} {order}))"""


_SHARE = "coalesce((rn - 1)::DOUBLE / nullif(n - 1, 0), 0)"

# --------------------------------------------------------------------- validation

_KEY = "o_orderkey"
FILES = f"""files AS (
  SELECT model_id, 'mean' AS val_strategy, 'incoming/' || lpad(CAST(k AS VARCHAR), 12, '0') || '/' || filename AS path, filename, bytes FROM (
    SELECT *, CASE WHEN k % 41 = 0 THEN 'notes-' || k || '.csv' WHEN k % 43 = 0 THEN replace(name, '_m_', '_other_')
                   WHEN k % 47 = 0 THEN replace(name, '_val_mean', '_val_max') ELSE name END AS filename FROM (
      SELECT o_orderkey AS k, 'm_' || o_custkey AS model_id,
             {_pick(SETTINGS, _KEY)} || '_' || {_pick(TARGETS, f"({_KEY} // 3)")} || '_m_' || o_custkey || '_val_mean_predictions.csv' AS name,
             CAST(floor(o_totalprice * 1000) AS BIGINT) AS bytes
      FROM orders)))"""
_PATTERN = "^(time-split|spatial-easy40|TA40)_(GPP|ET|NEE)_(.*)_val_(mean|max|discrepancy)(_predictions)?[.]csv$"
JUDGED = f"""named AS (
  SELECT *, regexp_matches(filename, '{_PATTERN}') AS hit, regexp_extract(filename, '{_PATTERN}', 1) AS setting,
         regexp_extract(filename, '{_PATTERN}', 2) AS target, regexp_extract(filename, '{_PATTERN}', 3) AS nmodel,
         regexp_extract(filename, '{_PATTERN}', 4) AS nstrategy, regexp_extract(filename, '{_PATTERN}', 5) AS tail FROM files),
fit AS (
  SELECT *, row_number() OVER w AS rn, first_value(filename) OVER w AS first_filename FROM named
  WHERE hit AND nmodel = model_id AND nstrategy = val_strategy
  WINDOW w AS (PARTITION BY model_id, val_strategy, setting, target ORDER BY path)),
combos AS (SELECT s || ' x ' || t AS combo FROM (VALUES ('TA40'), ('spatial-easy40'), ('time-split')) a(s), (VALUES ('ET'), ('GPP'), ('NEE')) b(t)),
lacking AS (
  SELECT u.model_id, u.val_strategy, string_agg(c.combo, ', ' ORDER BY c.combo) AS missing
  FROM (SELECT DISTINCT model_id, val_strategy FROM files) u CROSS JOIN combos c
  LEFT JOIN (SELECT model_id, val_strategy, setting || ' x ' || target AS combo FROM fit WHERE rn = 1) f
    ON f.model_id = u.model_id AND f.val_strategy = u.val_strategy AND f.combo = c.combo
  WHERE f.combo IS NULL GROUP BY ALL)"""
FILE_MESSAGES = """
  SELECT model_id, val_strategy, 'files' AS check_name, 'error' AS severity, message FROM (
    SELECT model_id, val_strategy, '`' || filename || '`: not named {setting}_{target}_{model}_val_{strategy}_predictions.csv' AS message FROM named WHERE NOT hit
    UNION ALL SELECT model_id, val_strategy, '`' || filename || '`: names the model `' || nmodel || '`, claimed is `' || model_id || '`' FROM named WHERE hit AND nmodel <> model_id
    UNION ALL SELECT model_id, val_strategy, '`' || filename || '`: names the strategy `' || nstrategy || '`, claimed is `' || val_strategy || '`' FROM named WHERE hit AND nmodel = model_id AND nstrategy <> val_strategy
    UNION ALL SELECT model_id, val_strategy, setting || ' x ' || target || ' has a second file `' || filename || '` beside `' || first_filename || '`' FROM fit WHERE rn > 1
    UNION ALL SELECT model_id, val_strategy, 'no file for ' || missing FROM lacking)"""

PROFILE = f"""keyed AS (
  SELECT {EXP}, site_id, "time", count(*) AS copies, count(*) FILTER (isnan(y_pred)) AS n_nan, count(*) FILTER (isinf(y_pred)) AS n_inf,
         count(*) FILTER (NOT isnan(y_pred) AND abs(y_pred) > 1e6) AS n_big, max(y_true) AS y_sub FROM sub GROUP BY ALL),
matched AS (
  SELECT k.*, t.site_id IS NOT NULL AS known, t.y_true AS y_ref FROM keyed k LEFT JOIN truth t
    ON k.setting = t.setting AND k.target = t.target AND k.site_id = t.site_id AND k."time" = t."time"),
counted AS (
  SELECT {EXP}, CAST(sum(copies) AS BIGINT) AS n_rows, CAST(sum(copies - 1) AS BIGINT) AS n_dup, CAST(sum(n_nan) AS BIGINT) AS n_nan,
         CAST(sum(n_inf) AS BIGINT) AS n_inf, CAST(sum(n_big) AS BIGINT) AS n_big, count(*) FILTER (known) AS n_match,
         count(*) FILTER (NOT known) AS n_extra,
         count(*) FILTER (known AND NOT coalesce(abs(y_sub - y_ref) <= 1e-6 + 1e-5 * abs(y_ref), FALSE)) AS n_bad,
         max(CASE WHEN known AND abs(y_sub - y_ref) > 1e-6 + 1e-5 * abs(y_ref) THEN abs(y_sub - y_ref) END) AS worst
  FROM matched GROUP BY ALL),
profile AS (
  SELECT c.*, r.n AS n_required, r.n - c.n_match AS n_missing, n_dup = 0 AND n_nan = 0 AND n_inf = 0 AS sound
  FROM counted c JOIN (SELECT setting, target, count(*) AS n FROM truth GROUP BY ALL) r ON c.setting = r.setting AND c.target = r.target)"""


def _examples(side: str, src: str) -> str:
    return f"""SELECT {EXP}, string_agg('(' || site_id || ' @ ' || strftime("time", '%Y-%m-%d %H:%M:%S') || ')', ', ' ORDER BY site_id, "time") AS {side}_eg FROM (
    SELECT *, row_number() OVER (PARTITION BY {EXP} ORDER BY site_id, "time") AS rn FROM {src}) WHERE rn <= 5 GROUP BY ALL"""


EXAMPLES = f"""extra AS (SELECT {EXP}, site_id, "time" FROM matched WHERE NOT known),
missing AS (
  SELECT p.setting, p.target, p.model, p.val_strategy, t.site_id, t."time" FROM truth t JOIN profile p ON t.setting = p.setting AND t.target = p.target
  LEFT JOIN keyed k ON k.setting = p.setting AND k.target = p.target AND k.model = p.model AND k.val_strategy = p.val_strategy
    AND k.site_id = t.site_id AND k."time" = t."time" WHERE k.site_id IS NULL),
extra_eg AS ({_examples('extra', 'extra')}),
missing_eg AS ({_examples('missing', 'missing')})"""
_TAG = "setting || ' x ' || target"
INDEX_MESSAGES = f"""
  SELECT model AS model_id, val_strategy, 'index_completeness' AS check_name, 'error' AS severity, {_TAG} || ': ' || n_missing || ' required rows are absent (first: ' || missing_eg || ')' AS message
  FROM profile JOIN missing_eg USING ({EXP}) WHERE n_missing > 0
  UNION ALL SELECT model, val_strategy, 'index_completeness', 'error', {_TAG} || ': ' || n_extra || ' rows are not in the truth (first: ' || extra_eg || ')'
  FROM profile JOIN extra_eg USING ({EXP}) WHERE n_extra > 0"""
CONTENT_MESSAGES = "\n UNION ALL ".join(
    f"SELECT model AS model_id, val_strategy, 'content_caps' AS check_name, 'error' AS severity, {_TAG} || ': ' || {n} || '{tail}' AS message FROM profile WHERE {n} > 0"
    for n, tail in (
        ("n_dup", " rows repeat a (site_id, time)"), ("n_nan", " predictions are NaN"),
        ("n_inf", " predictions are infinite"), ("n_big", " predictions are larger than 1e+06")))
INTEGRITY_MESSAGES = f"""
  SELECT model AS model_id, val_strategy, 'ytrue_integrity' AS check_name, 'error' AS severity, {_TAG} || ': y_true differs from the truth in ' || n_bad || ' of ' || n_match ||
    ' rows (' || format('{{:.2f}}', n_bad::DOUBLE / n_match * 100) || '%, at most by ' || coalesce(format('{{:.3g}}', worst), '-') || ')' AS message
  FROM profile WHERE sound AND n_bad > 0"""
INTEGRITY_MESSAGES += f"""
  UNION ALL SELECT model, val_strategy, 'ytrue_integrity', 'error', {_TAG} || ': shares no row with the truth' FROM profile WHERE sound AND n_match = 0"""
# The submissions as files: one file lost its rows, two cannot be read, one model has faulty truth values.
_UNREAD = "model = 'short' AND setting = 'TA40' AND target <> 'NEE'"
FILE_ROWS = SUB.replace("sub AS (", "sub_all AS (") + f""",
sub AS (
  SELECT * REPLACE (CASE WHEN model = 'shifted' AND setting = 'TA40' THEN CASE target WHEN 'NEE' THEN 'Infinity'::DOUBLE END ELSE y_true END AS y_true)
  FROM sub_all WHERE NOT (model = 'late' AND setting = 'TA40' AND target = 'GPP') AND NOT ({_UNREAD}))"""
_COUNTS = ["n_rows", "n_dup", "n_nan", "n_inf", "n_big", "n_match", "n_extra", "n_bad"]
FILE_PROFILE = PROFILE.replace("counted AS (", "counted_rows AS (").replace("profile AS (", f"""counted AS (
  SELECT o.*, {", ".join(f"coalesce(c.{n}, 0) AS {n}" for n in _COUNTS)}, c.worst
  FROM (SELECT DISTINCT {EXP} FROM sub_all WHERE NOT ({_UNREAD})) o LEFT JOIN counted_rows c USING ({EXP})),
profile AS (""")
READ_MESSAGES = f"""SELECT DISTINCT model AS model_id, val_strategy, 'content_caps' AS check_name, 'error' AS severity,
  {_TAG} || ': cannot be read: missing columns time' AS message FROM sub_all WHERE {_UNREAD}"""
EVENT_FILES = """listed AS (
  SELECT DISTINCT setting, target, model AS model_id, val_strategy, setting || '_' || target || '_' || model || '_val_' || val_strategy || '_predictions.csv' AS name FROM sub_all),
files AS (
  SELECT model_id, val_strategy, name AS path, name AS filename FROM listed
  UNION ALL SELECT model_id, val_strategy, 'second/' || name, name FROM listed WHERE model_id = 'copied' AND setting = 'TA40' AND target = 'GPP'
  UNION ALL SELECT model_id, val_strategy, 'strange/' || replace(name, 'copied', 'clean'), replace(name, 'copied', 'clean') FROM listed
    WHERE model_id = 'copied' AND setting = 'TA40' AND target = 'GPP')"""

# --------------------------------------------------------------------- registry

REGISTRY = """reg AS (
  SELECT c_custkey AS k, c_name, ['mean', 'max', 'discrepancy'][c_custkey % 3 + 1] AS val_strategy, 'm_' || (c_custkey // 3) AS model_id,
         CASE WHEN c_custkey % 13 = 0 THEN 'scored' WHEN c_custkey % 17 = 0 THEN 'draft' ELSE 'pending' END AS status FROM customer),
entries AS (SELECT r.*, n FROM reg r CROSS JOIN (VALUES ('0'), ('1')) e(n) WHERE k % 19 <> 0),
faults AS (
  SELECT k, 1 AS pos, 0 AS sub, 'lacks the field email' AS message FROM reg WHERE k % 7 = 0
  UNION ALL SELECT k, 2, 0, 'lacks the field submitted_at' FROM reg WHERE k % 11 = 0
  UNION ALL SELECT k, 3, 0, 'unknown status ''draft''' FROM reg WHERE status = 'draft'
  UNION ALL SELECT k, 4, 0, 'lists no files' FROM reg WHERE k % 19 = 0
  UNION ALL SELECT k, 5, CAST(n AS INT) * 10 + 1, 'file ''file_' || n || ''' lacks the field target' FROM entries WHERE k % 23 = 0
  UNION ALL SELECT k, 5, CAST(n AS INT) * 10 + 2, 'file ''file_' || n || ''' lacks the field r2_key' FROM entries WHERE k % 29 = 0 AND status = 'pending'
  UNION ALL SELECT k, 5, CAST(n AS INT) * 10 + 3, 'file ''file_' || n || ''' lacks the field sha256' FROM entries WHERE status = 'scored')"""

# --------------------------------------------------------------------- incremental

_STRICT = "NOT EXISTS (SELECT 1 FROM broken_days b WHERE b.model = x.model AND b.setting = x.setting AND b.target = x.target AND b.val_strategy = x.val_strategy)"
EVENT_METRICS = [
    TRUTH, SCORED_SUB, JOINED, _daily("env", 1, "daily_env"), _daily("site_id", 1, "daily_site"),
    f"broken_days AS (SELECT DISTINCT {EXP} FROM daily_env WHERE yp IS NULL)",
    _stack(ALL_SCALES, 2, 2, _STRICT, _STRICT),
    _metrics("stacked"),
    f"uncovered AS (SELECT DISTINCT {EXP} FROM pred WHERE y_true IS NULL)",
]

ORACLE: dict[str, str] = {
    "hourly_masked": _with(PRED_EVENTS, body=f'SELECT {EXP}, env, "time", {_r("y_true", "y_true")}, {_r("y_pred", "y_pred")} FROM pred WHERE y_true > 50'),
    "daily_mean_threshold": _with(PRED_LINEITEM, _daily("site_id", 12), body=_out("SELECT *, CAST(d AS TIMESTAMP) AS t FROM daily", "site_id")),
    "daily_passthrough": _with(
        PRED_LINEITEM, _daily("site_id", 4),
        "single AS (SELECT setting, target, 'daily' AS model, val_strategy, env, site_id, CAST(CAST(\"time\" AS DATE) AS TIMESTAMP) + INTERVAL 6 HOUR AS t, min(y_true) AS yt, min(y_pred) AS yp FROM pred GROUP BY ALL)",
        body=_out("""SELECT setting, target, 'hourly' AS model, val_strategy, unit, CAST(d AS TIMESTAMP) AS t, yt, yp FROM daily
  UNION ALL SELECT setting, target, model, val_strategy, site_id, t, yt, yp FROM single""", "site_id")),
    "weekly_mean": _with(PRED_EVENTS, _daily("env", 12), body=_out(_period(WEEK, 4, "daily"), "env")),
    "monthly_mean": _with(PRED_LINEITEM, _daily("env", 4), body=_out(_period(MONTH, 15, "daily"), "env")),
    "yearly_mean": _with(PRED_LINEITEM, _daily("site_id", 12), body=_out(_period(YEAR, 183, "daily"), "site_id")),
    "seasonal_cycle": _with(PRED_LINEITEM, _daily("site_id", 12), body=_out(_seasonal(2, "daily"), "site_id", "doy", "doy")),
    "seasonal_cycle_median": _with(PRED_LINEITEM, _daily("site_id", 4), body=_out(
        _seasonal(2, "daily").replace("avg(", "median("), "site_id", "doy", "doy")),
    "anomaly": _with(PRED_LINEITEM, _daily("site_id", 4), body=_out(_anom(2, "daily"), "site_id")),
    "interannual_variability": _with(PRED_LINEITEM, _daily("site_id", 4), body=_out(_iav(183, "daily"), "site_id")),
    "site_mean": _with(PRED_LINEITEM, _daily("site_id", 4), body=_out(_spatial("daily"), "site_id", None)),
    "weighted_fraction_threshold": _with(PRED_LINEITEM, body=_out(f"""
  SELECT {EXP}, site_id AS unit, CAST(CAST("time" AS DATE) AS TIMESTAMP) AS t,
         CASE WHEN coalesce(sum(abs(y_true)) FILTER (y_pred < 35), 0) / nullif(sum(abs(y_true)), 0) < 0.6 THEN NULL ELSE avg(y_true) END AS yt,
         avg(y_pred) AS yp FROM pred GROUP BY ALL""", "site_id")),
    "masked_weekly_fraction": _with(PRED_LINEITEM, f"""days AS (
  SELECT *, yt IS NOT NULL AND yp IS NOT NULL AS ok FROM (SELECT {EXP}, site_id AS unit, CAST("time" AS DATE) AS d,
    CASE WHEN count(*) FILTER (y_pred < 40) >= 4 THEN avg(y_true) END AS yt, avg(y_pred) AS yp FROM pred GROUP BY ALL))""", body=_out(f"""
  SELECT {EXP}, unit, {WEEK} AS t,
         CASE WHEN coalesce(sum(abs(yt)) FILTER (ok), 0) / nullif(sum(abs(yt)), 0) < 0.5 THEN NULL ELSE avg(yt) END AS yt, avg(yp) AS yp
  FROM days GROUP BY ALL""", "site_id")),
    "metrics_hourly": _with(PRED_EVENTS, _stack(["hourly"]), _metrics("stacked"), body=METRICS_OUT),
    "metrics_all_scales": _with(*MODEL_METRICS, body=METRICS_OUT),
    "sample_size_summary": _with(*MODEL_METRICS, body=f"""SELECT {EXP}, scale, count(*) AS groups, min(n_samples) AS min_samples,
  {_r('avg(n_samples)', 'mean_samples')}, max(n_samples) AS max_samples FROM metrics GROUP BY ALL"""),
    "custom_metrics": _with(PRED_LINEITEM, _daily("site_id", 4), body=f"""SELECT {EXP}, 'yearly' AS scale, unit AS env, count(*) AS n_samples,
  {_r('max(abs(yp - yt))', 'max_error')}, {_r('avg(pow(ln(1 + yp) - ln(1 + yt), 2))', 'mean_square_log')}
  FROM ({_period(YEAR, 100, 'daily')}) GROUP BY ALL"""),
    "scale_status": _with(TRUTH, SUB, JOINED, body=f"""SELECT {EXP}, u.unit, max(n) <= 1 AS daily_input,
  CASE WHEN count(*) FILTER (yp IS NULL) > 0 THEN 'null_prediction'
       WHEN count(*) FILTER (n >= 2 AND yt IS NOT NULL) = 0 AND max(n) > 1 THEN 'no_truth' ELSE 'ok' END AS state
  FROM (SELECT {EXP}, env, CAST("time" AS DATE) AS d, count(*) AS n, avg(y_true) AS yt, avg(y_pred) AS yp FROM pred GROUP BY ALL)
  CROSS JOIN (VALUES ('env'), ('site_id')) u(unit) GROUP BY ALL"""),
    "truth_manifest": _with(TRUTH, body="""SELECT setting, target, count(*) AS rows, count(DISTINCT site_id) AS sites, min("time") AS time_min, max("time") AS time_max FROM truth GROUP BY ALL"""),
    "truth_assertions": _with(TRUTH, body="""SELECT s AS setting, t AS target, count(y) AS rows, count(y) - count(DISTINCT y) AS duplicates,
  count(*) FILTER (y IS NOT NULL AND NOT isfinite(v)) AS non_finite, count(y) > 0 AND count(y) = count(DISTINCT y) AND count(*) FILTER (y IS NOT NULL AND NOT isfinite(v)) = 0 AS passed
  FROM (VALUES ('TA40'), ('spatial-easy40'), ('time-split')) a(s) CROSS JOIN (VALUES ('ET'), ('GPP'), ('NEE')) b(t)
  LEFT JOIN (SELECT setting, target, site_id || '@' || CAST("time" AS VARCHAR) AS y, y_true AS v FROM truth) x ON x.setting = s AND x.target = t GROUP BY ALL"""),
    "manifest_verification": _with(TRUTH, body="""SELECT setting, target, CASE WHEN setting = 'TA40' THEN n + 1 ELSE n END AS rows, n AS rows_now,
  s AS sites, s AS sites_now, setting <> 'TA40' AS matches FROM (SELECT setting, target, count(*) AS n, count(DISTINCT site_id) AS s FROM truth GROUP BY ALL)"""),
    "truth_coverage": _with(TRUTH, SUB, JOINED, body=f"SELECT {EXP}, count(*) AS rows, count(*) FILTER (y_true IS NULL) AS unmatched, count(*) FILTER (y_true IS NULL) = 0 AS covered FROM pred GROUP BY ALL"),
    "truth_join_score": _with(*EVENT_METRICS, body=METRICS_OUT + f" ANTI JOIN uncovered USING ({EXP})"),
    "file_names": _with(FILES, f"""n AS (SELECT path, regexp_matches(filename, '{_PATTERN}') AS hit, regexp_extract(filename, '{_PATTERN}', 1) AS s, regexp_extract(filename, '{_PATTERN}', 2) AS t,
  regexp_extract(filename, '{_PATTERN}', 3) AS m, regexp_extract(filename, '{_PATTERN}', 4) AS v FROM files)""", body="""SELECT path, CASE WHEN hit THEN s END AS setting, CASE WHEN hit THEN t END AS target,
  CASE WHEN hit THEN m END AS model, CASE WHEN hit THEN v END AS val_strategy, CASE WHEN hit THEN TRUE END AS is_raw,
  CASE WHEN hit THEN s || '_' || t || '_' || m || '_val_' || v || '.csv' END AS metrics_file FROM n"""),
    "check_files": _with(FILES, JUDGED, body=FILE_MESSAGES),
    "check_sizes": _with(FILES, JUDGED, body=f"""SELECT model_id, val_strategy, 'content_caps' AS check_name, 'error' AS severity,
  {_TAG} || ': has ' || bytes || ' bytes, more than 400000000' AS message FROM fit WHERE rn = 1 AND bytes > 400000000"""),
    "check_content": _with(TRUTH, SUB, PROFILE, body=f"SELECT {EXP}, n_rows, n_dup, n_nan, n_inf, n_big, sound FROM profile"),
    "check_index": _with(TRUTH, SUB, PROFILE, EXAMPLES, body=INDEX_MESSAGES),
    "check_integrity": _with(TRUTH, SUB, PROFILE, body=f"SELECT {EXP}, n_match, n_bad, {_r('CASE WHEN sound THEN n_bad::DOUBLE / n_match END', 'bad_frac')}, {_r('worst', 'worst')} FROM profile"),
    "check_ownership": """SELECT model_id, 'mean' AS val_strategy, 'ownership' AS check_name, severity, message FROM (
  SELECT 'm_' || c_custkey AS model_id, 'error' AS severity, 'model `m_' || c_custkey || '` is recorded for another owner' AS message
    FROM customer WHERE c_custkey % 3 = 1 OR (c_custkey % 3 = 0 AND c_custkey % 5 = 0)
  UNION ALL SELECT 'm_' || c_custkey, 'warning', 'new model `m_' || c_custkey || '` names no owner' FROM customer WHERE c_custkey % 3 = 2 AND c_custkey % 5 = 0)""",
    "validation_report": _with(
        TRUTH, FILE_ROWS, EVENT_FILES, JUDGED, FILE_PROFILE, EXAMPLES,
        f"found AS ({FILE_MESSAGES} UNION ALL {READ_MESSAGES} UNION ALL {CONTENT_MESSAGES} UNION ALL {INDEX_MESSAGES} UNION ALL {INTEGRITY_MESSAGES})",
        """own AS (SELECT 'late' AS model_id, 'ownership' AS check_name, 'model `late` is recorded for another owner' AS e, '' AS w
  UNION ALL SELECT 'short', 'ownership', '', 'new model `short` names no owner')""",
        """checks AS (SELECT model_id, val_strategy, check_name FROM (SELECT DISTINCT model AS model_id, val_strategy FROM sub_all)
  CROSS JOIN (VALUES ('files'), ('content_caps'), ('index_completeness'), ('ytrue_integrity'), ('ownership')) v(check_name))""",
        body="""SELECT c.model_id, c.val_strategy, c.check_name, coalesce(f.e, o.e, '') = '' AS passed, coalesce(f.e, o.e, '') AS errors, coalesce(o.w, '') AS warnings
  FROM checks c LEFT JOIN (SELECT model_id, val_strategy, check_name, string_agg(message, chr(10) ORDER BY message) AS e FROM found GROUP BY ALL) f
    ON f.model_id = c.model_id AND f.val_strategy = c.val_strategy AND f.check_name = c.check_name
  LEFT JOIN own o ON o.model_id = c.model_id AND o.check_name = c.check_name"""),
    "regression_compare": _with(
        *MODEL_METRICS,
        """pairs AS (UNPIVOT (SELECT target, setting, model, val_strategy, scale, env, """ + ", ".join(
            f"coalesce({m}, 'NaN'::DOUBLE) AS {m}" for m in ("mse", "rmse", "mae", "nse", "r2_score", "bias")) + """ FROM metrics)
  ON mse, rmse, mae, nse, r2_score, bias INTO NAME metric VALUE a)""",
        """pair AS (SELECT *, CASE WHEN metric = 'rmse' AND env LIKE 'A%' THEN a * 1.0001::DOUBLE WHEN metric = 'nse' AND scale = 'weekly' AND env LIKE '%1996' THEN 'NaN'::DOUBLE ELSE a END AS b FROM pairs)""",
        body=f"""SELECT {EXP}, metric, count(*) AS cells,
  count(*) FILTER (isfinite(a) <> isfinite(b)) + count(*) FILTER (isfinite(a) AND isfinite(b) AND abs(a - b) > 1e-9 + 1e-6 * abs(b)) AS mismatches,
  {_r("coalesce(max(CASE WHEN isfinite(a) AND isfinite(b) AND abs(b) > 1e-8 THEN abs(a - b) / abs(b) END), 0)", 'worst_relative')}
  FROM pair GROUP BY ALL"""),
    "leaderboard_cells_median": _with(*BOARD, _cells(), body=f"SELECT * REPLACE ({_r('value')} AS value) FROM cells"),
    "leaderboard_cells_q90": _with(*BOARD, _cells(0.9), body=f"SELECT * REPLACE ({_r('value')} AS value) FROM cells"),
    "leaderboard_cells_mean": _with(*BOARD, _cells(None), body=f"SELECT * REPLACE ({_r('value')} AS value) FROM cells"),
    "leaderboard_wide": _with(*BOARD, _cells(), body="SELECT target, model, val_strategy, " + ", ".join(
        _r(f"max(value) FILTER (setting = '{s}' AND scale = '{c}')", f"{s}_{c}".replace("-", "_").lower()) for s, c in _WIDE_COLUMNS
    ) + " FROM cells GROUP BY ALL"),
    "skill_scores": _with(*BOARD, _cells(), *_skills(), body=f"""SELECT k.target, k.model, k.val_strategy, k.setting, k.scale, {_r('value', 'value')},
  {_r('baseline_value', 'baseline_value')}, {_r('skill', 'skill')}, {_r('overall', 'overall')} FROM skills k JOIN overall o
  ON k.target = o.target AND k.model = o.model AND k.val_strategy = o.val_strategy"""),
    "leaderboard_ranked": _with(
        *BOARD, _cells(0.5, "c50"), _cells(0.9, "c90"), *_skills("c50", "m_"), *_skills("c90", "q_"), _LABELS,
        body=_page("median", "m_") + "\nUNION ALL " + _page("q90", "q_")),
    "relative_to_best": _with(*BOARD, _cells(), *_skills(), f"c AS (SELECT *, {_closeness()} AS s FROM skills)", body=f"""
  SELECT target, model, val_strategy, setting, scale, {_r('s', 'closeness')},
    format('{{:02X}}{{:02X}}{{:02X}}', CAST(trunc(255 - s * 156) AS INT), CAST(trunc(255 - s * 65) AS INT), CAST(trunc(255 - s * 132) AS INT)) AS colour,
    format('{{:.2g}}', value + 1e-10::DOUBLE) AS text FROM c"""),
    "cdf_curve": _with(*BOARD, body=_curve("rmse", "ASC", "v", _SHARE, ("value", "share"))),
    "quantile_curve": _with(*BOARD, body=_curve("nse", "DESC", _SHARE, "v", ("x", "y"))),
    "metric_by_setting": _with(*BOARD, body=f"""SELECT target, setting, scale, model, val_strategy, {_r('quantile_cont(rmse, 0.5)', 'value')},
  CAST({_SETTINGS_ORDER} AS BIGINT) AS setting_order, CAST({_MODEL_ORDER} AS BIGINT) AS model_order
  FROM metrics WHERE rmse IS NOT NULL AND scale <> 'site-mean' GROUP BY ALL"""),
    "axis_bound": _with(*BOARD, body=f"SELECT target, scale, {_r('max(rmse)', 'upper')} FROM metrics GROUP BY ALL"),
    "model_order": _with(*BOARD, _cells(), *_skills(), body=f"""SELECT t.target, m.model, o.val_strategy, CAST(m.p AS BIGINT) AS position, {_r('o.overall', 'overall')}
  FROM (SELECT DISTINCT target FROM overall) t CROSS JOIN (VALUES ('constant', 0), ('lr', 1), ('mlp', 2)) m(model, p)
  LEFT JOIN overall o ON o.target = t.target AND o.model = m.model"""),
    "metadata_schema_check": _with(REGISTRY, body="""SELECT 'submissions/' || r.model_id || '_val_' || r.val_strategy || '/metadata.json' AS path, r.model_id, r.val_strategy,
  count(f.k) AS n_problems, coalesce(string_agg(f.message, ' | ' ORDER BY f.pos, f.sub), '') AS problems FROM reg r LEFT JOIN faults f ON r.k = f.k GROUP BY ALL"""),
    "intake_gate": _with(REGISTRY, """lost AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n) AS rn FROM entries e
  WHERE status = 'pending' AND NOT EXISTS (SELECT 1 FROM faults f WHERE f.k = e.k)
    AND ((k % 31 = 0 AND n = '1') OR (k % 31 <> 0 AND k % 37 = 0)))""", body="""SELECT r.model_id, r.val_strategy, 'metadata' AS check_name, 'error' AS severity, m.message FROM reg r JOIN (
    SELECT k, message FROM faults
    UNION ALL SELECT k, 'only a `pending` submission can be taken in' FROM reg WHERE status <> 'pending'
    UNION ALL SELECT k, 'no stored object for `incoming/' || model_id || '_val_' || val_strategy || '/file_' || n || '`' FROM lost WHERE rn = 1) m ON r.k = m.k"""),
    "recorded_owner": _with(REGISTRY, body="SELECT model_id, arg_min(c_name, 'submissions/' || model_id || '_val_' || val_strategy || '/metadata.json') AS recorded_owner FROM reg GROUP BY ALL"),
    "submitter_identity": """SELECT c_custkey, email, regexp_matches(email, '^[^\\s@]+@[^\\s@]+\\.[^\\s@]+$') AS email_ok, sha256(email) AS owner, slug,
  regexp_matches(slug, '^[a-z0-9][a-z0-9_-]{0,48}$') AS slug_ok FROM (
    SELECT c_custkey, lower(replace(c_name, '#', '@') || '.ORG') AS email, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE 'm-' || c_custkey END AS slug FROM customer)""",
    "missing_experiments": _with(FILES, f"""have AS (SELECT DISTINCT regexp_extract(filename, '{_PATTERN}', 1) AS s, regexp_extract(filename, '{_PATTERN}', 2) AS t,
  regexp_extract(filename, '{_PATTERN}', 3) AS m, regexp_extract(filename, '{_PATTERN}', 4) AS v FROM files WHERE regexp_matches(filename, '{_PATTERN}'))""", body="""SELECT a.s AS setting, b.t AS target, u.model_id AS model, u.val_strategy
  FROM (SELECT DISTINCT model_id, val_strategy FROM files) u CROSS JOIN (VALUES ('TA40'), ('spatial-easy40'), ('time-split')) a(s) CROSS JOIN (VALUES ('ET'), ('GPP'), ('NEE')) b(t)
  WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.s = a.s AND h.t = b.t AND h.m = u.model_id AND h.v = u.val_strategy)"""),
    "quota_admission": """WITH a AS (SELECT event_id AS call_id, user_id AS client, ts AS "time",
    row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS h FROM events),
  b AS (SELECT call_id, row_number() OVER (PARTITION BY CAST("time" AS DATE) ORDER BY "time", call_id) AS d FROM a WHERE h <= 1)
  SELECT a.call_id, a.client, a."time", CASE WHEN h > 1 THEN 'hourly_limit' WHEN d > 50 THEN 'daily_limit' ELSE 'admitted' END AS decision FROM a LEFT JOIN b ON a.call_id = b.call_id""",
    "incremental_pending": _with(SUB, body="SELECT DISTINCT model, val_strategy FROM sub WHERE model NOT IN ('clean', 'shifted')"),
    "incremental_score": _with(*EVENT_METRICS, body=METRICS_OUT + " WHERE NOT EXISTS (SELECT 1 FROM uncovered u WHERE u.model = metrics.model AND u.val_strategy = metrics.val_strategy) AND model <> 'copied'"),
    "incremental_status": _with(TRUTH, SUB, JOINED, body="""SELECT rows, unmatched, absent, CASE WHEN unmatched = 0 AND absent = 0 THEN 'scored' ELSE 'failed' END AS status, model, val_strategy FROM (
  SELECT model, val_strategy, count(*) AS rows, count(*) FILTER (y_true IS NULL) AS unmatched, max(CASE model WHEN 'copied' THEN 1 ELSE 0 END)::BIGINT AS absent FROM pred GROUP BY ALL)"""),
}
ORACLE["incremental_stream"] = ORACLE["incremental_score"]

_REPORT = ORACLE["validation_report"]
ORACLE["validation_overall"] = f"""SELECT model_id, val_strategy, bool_and(passed) AS passed, count(*) AS n_checks, bool_and(passed) AS report_passed
FROM ({_REPORT}) GROUP BY ALL"""
ORACLE["validation_text"] = f"""SELECT model_id, val_strategy, check_name, CASE WHEN passed THEN '- [x] ' ELSE '- [ ] ' END || check_name
  || CASE WHEN errors <> '' THEN chr(10) || '    - ' || replace(errors, chr(10), chr(10) || '    - ') ELSE '' END
  || CASE WHEN warnings <> '' THEN chr(10) || '    - warning: ' || replace(warnings, chr(10), chr(10) || '    - warning: ') ELSE '' END AS text
FROM ({_REPORT})"""
ORACLE["truth_store"] = _with(TRUTH, body=f"""SELECT setting, target, count(*) AS rows, min(site_id) AS first_site, max("time") AS last_time,
  {_r('sum(y_true)', 'total', 4)} FROM truth GROUP BY ALL""")
ORACLE["metric_files"] = _with(
    PRED_EVENTS, _daily("env", 1, "daily_env"), _daily("site_id", 1, "daily_site"), _stack(ALL_SCALES, 2, 2), _metrics("stacked"), body=METRICS_OUT)
ORACLE["manifest_store"] = _with(TRUTH, body="""SELECT setting, target, count(*) AS rows, count(DISTINCT site_id) AS sites, min("time") AS time_min, max("time") AS time_max,
  (SELECT count(*) FROM truth) AS total_rows, 'lr' AS truth_model, 'mean' AS val_strategy, TRUE AS matches FROM truth GROUP BY setting, target""")
ORACLE["manifest_fingerprint"] = _with(TRUTH, body="""SELECT setting, target, count(*) AS rows, NOT bool_or(CAST(site_id AS BIGINT) % 97 = 0) AS matches, TRUE AS statistics_match
  FROM truth GROUP BY setting, target""")
_GATE = [
    ("clean", ""), ("short", ""), ("broken", ""), ("late", "lacks the field email"),
    ("copied", "only a `pending` submission can be taken in@unknown status ~draft~"),
    ("shifted", "no stored object for `incoming/TA40_NEE_shifted_val_mean_predictions.csv`"),
]
ORACLE["intake_report"] = f"""SELECT model_id, val_strategy, CAST(list_position(['metadata', 'files', 'content_caps', 'index_completeness', 'ytrue_integrity', 'ownership'], check_name) AS BIGINT) AS stage,
  check_name, passed, errors, warnings FROM (
  SELECT * FROM ({_REPORT}) WHERE model_id IN ('clean', 'short', 'broken')
  UNION ALL SELECT m, 'mean', 'metadata', e = '', replace(replace(e, '@', chr(10)), '~', chr(39)), '' FROM (VALUES {", ".join(f"('{m}', '{e}')" for m, e in _GATE)}) v(m, e))"""
ORACLE["metric_store"] = _with(
    *MODEL_METRICS, body=METRICS_OUT + " WHERE val_strategy = 'mean' AND setting IN ('TA40', 'time-split') AND scale IN ('weekly', 'iav')")
_TEXT = lambda v, d: f"coalesce(format('{{:.{d}f}}', {v}), '-')"
ORACLE["leaderboard_texts"] = _with(
    *BOARD, _cells(0.9), *_skills(),
    f"c AS (SELECT *, {_closeness()} AS s, CASE scale WHEN 'hourly' THEN 2.0 WHEN 'iav' THEN 0.5 ELSE 1.0 END::DOUBLE AS w FROM skills)",
    """scored AS (SELECT target, model, val_strategy, sum(w * skill) / nullif(sum(w) FILTER (skill IS NOT NULL), 0) AS score FROM c GROUP BY ALL)""",
    body=f"""SELECT c.target, r.place, c.model, c.val_strategy, c.setting, c.scale, {_r('r.score', 'overall', 4)}, {_r('c.s', 'closeness', 4)},
  CASE WHEN c.target = 'ET' THEN {_TEXT('c.value', 4)} ELSE {_TEXT('c.value', 2)} END AS value_text, {_TEXT('c.skill', 2)} AS skill_text,
  {_TEXT('r.score', 2)} AS overall_text,
  format('{{:02X}}{{:02X}}{{:02X}}', CAST(trunc(255 - s * 156) AS INT), CAST(trunc(255 - s * 65) AS INT), CAST(trunc(255 - s * 132) AS INT)) AS colour
  FROM c JOIN (SELECT *, rank() OVER (PARTITION BY target ORDER BY score DESC) AS place FROM scored) r USING (target, model, val_strategy)""")
