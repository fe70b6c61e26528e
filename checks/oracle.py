"""The same results as SQL over the ``events`` table, for DuckDB."""

from __future__ import annotations

from checks.queries import ALL_GROUPS, HASHED
from clickcast.operators.counts import GROUPS
from clickcast.operators.encode import CATEGORIES
from clickcast.operators.models import BOOSTED
from clickcast.operators.rates import FOLDS, WEIGHT

CLICKS = """clicks AS (
  SELECT event_id, user_id AS ip, k % 10 AS app, k % 3 AS device, k // 10 AS os, event_type AS channel, ts AS click_time,
         CAST(k % 10 < 3 AND event_type IN ('click', 'purchase') AS INT) AS is_attributed
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events))"""

PREPARED = f"""{CLICKS},
prepared AS (
  SELECT event_id, ip, app, device, os, channel, is_attributed AS label,
         CAST(hour(click_time) AS INT) AS hour, CAST(day(click_time) AS INT) AS day
  FROM clicks)"""


def tenth(digits: int = 0) -> str:
    return f"(('0x' || substr(md5(CAST(event_id AS VARCHAR)), {1 + 8 * digits}, 8))::BIGINT % 10)"


PARTS = f"""{PREPARED},
train AS (SELECT * FROM prepared WHERE {tenth()} < 9),
test AS (SELECT * FROM prepared WHERE {tenth()} >= 9)"""


def counted(source: str, groups=GROUPS) -> str:
    """Group counts as windows; a row with a null key is dropped after it is counted."""
    windows = ", ".join(f"count(*) OVER (PARTITION BY {', '.join(keys)}) AS {name}" for name, keys in groups.items())
    keys = dict.fromkeys(k for group in groups.values() for k in group)
    return f"SELECT * FROM (SELECT *, {windows} FROM {source}) WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in keys)


def labels(source: str, categories=CATEGORIES) -> str:
    """``col, label, n, idx`` for each value of each category."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, label, n, row_number() OVER (ORDER BY n DESC, label) - 1 AS idx FROM "
        f"(SELECT CAST({c} AS VARCHAR) AS label, count(*) AS n FROM {source} WHERE {c} IS NOT NULL GROUP BY 1)"
        for c in categories
    )


def offsets(categories=CATEGORIES) -> str:
    """``col, size, start``: each block's width and where it starts, with the numeric features after the last."""
    order = ", ".join(f"({i}, '{c}')" for i, c in enumerate(categories))
    return (
        "SELECT col, size, coalesce(sum(size) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start "
        f"FROM (VALUES {order}) o(i, col) JOIN (SELECT col, count(*) AS size FROM labels GROUP BY col) USING (col)"
    )


def entries(source: str, categories=CATEGORIES, numeric=tuple(GROUPS)) -> str:
    """``event_id, label, position, value`` for the non-zero entries of the feature vector."""
    blocks = [
        f"SELECT s.event_id, s.label, CAST(o.start + l.idx AS INT) AS position, CAST(1 AS DOUBLE) AS value FROM {source} s "
        f"JOIN labels l ON l.col = '{c}' AND l.label = CAST(s.{c} AS VARCHAR) JOIN offsets o ON o.col = '{c}'"
        for c in categories
    ]
    counts = [
        f"SELECT event_id, label, CAST((SELECT sum(size) FROM offsets) + {i} AS INT) AS position, "
        f"CAST({name} AS DOUBLE) AS value FROM {source}"
        for i, name in enumerate(numeric)
    ]
    return " UNION ALL ".join([*blocks, *counts])


ENCODED = f"""{PARTS},
train_rows AS ({counted('train')}),
test_rows AS ({counted('test')}),
labels AS ({labels('train_rows')}),
offsets AS ({offsets()}),
train_long AS ({entries('train_rows')}),
test_long AS ({entries('test_rows')})"""

def nb_fit(rows: str, long: str, width: str, smoothing: str = "SELECT CAST(1 AS DOUBLE) AS s") -> str:
    """CTEs ``priors`` and ``params`` of multinomial naive Bayes, for each smoothing.

    ``rows`` has one row per click with its label, ``long`` its feature entries, ``width`` the number of features.
    """
    return f"""smoothings AS ({smoothing}),
priors AS (
  SELECT s, label, ln(count(*) + s) - ln((SELECT count(*) FROM {rows}) + 2 * s) AS pi
  FROM {rows} CROSS JOIN smoothings GROUP BY s, label),
cells AS (
  SELECT c.label, p.position, coalesce(t.total, 0) AS total
  FROM (SELECT DISTINCT label FROM {rows}) c
  CROSS JOIN (SELECT CAST(unnest(range({width})) AS INT) AS position) p
  LEFT JOIN (SELECT label, position, sum(value) AS total FROM {long} GROUP BY 1, 2) t USING (label, position)),
params AS (
  SELECT s, label, position,
         CASE WHEN total + s = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE ln(total + s) END
           - ln(sum(total) OVER (PARTITION BY s, label) + s * {width}) AS theta
  FROM cells CROSS JOIN smoothings)"""


def nb_apply(long: str) -> str:
    """CTE ``scored``: per smoothing and click the label and the predicted class. Of equal scores class 0 wins."""
    return f"""raw AS (
  SELECT f.s, l.event_id, l.label, f.label AS class, sum(l.value * f.theta) + any_value(p.pi) AS score
  FROM {long} l JOIN params f USING (position) JOIN priors p ON p.s = f.s AND p.label = f.label
  GROUP BY 1, 2, 3, 4),
scored AS (
  SELECT s, event_id, label,
         CAST(max(score) FILTER (class = 1) > max(score) FILTER (class = 0) AS INT) AS prediction
  FROM raw GROUP BY 1, 2, 3)"""


HARD_AUROC = """(1 + count(*) FILTER (label = 1 AND prediction = 1) / count(*) FILTER (label = 1)
    - count(*) FILTER (label = 0 AND prediction = 1) / count(*) FILTER (label = 0)) / 2"""

FULL_WIDTH = f"(SELECT CAST(sum(size) AS BIGINT) + {len(GROUPS)} FROM offsets)"

# The label is a function of two categories that these models recover on every held-out click, so the label is the
# prediction they must give after the split, the counts, the encoding, the fit and the scoring.
LABEL_AS_PREDICTION = f"WITH {PARTS} SELECT event_id, CAST(label AS DOUBLE) AS prediction FROM test"

COUNT_AUROC = f"""WITH {PREPARED},
counted AS ({counted('prepared', {'app_day_h_dev': GROUPS['app_day_h_dev']})}),
ranked AS (SELECT label, rank() OVER (ORDER BY app_day_h_dev) + (count(*) OVER (PARTITION BY app_day_h_dev) - 1) / 2.0 AS r
           FROM counted)
SELECT round((sum(r) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
             / (CAST(count(*) FILTER (label = 1) AS DOUBLE) * count(*) FILTER (label = 0)), 9) AS auroc
FROM ranked"""

CSV = f"""WITH {CLICKS} SELECT event_id, ip, app, device, os, channel,
  strftime(click_time, '%Y-%m-%d %H:%M:%S.%f') AS click_time, is_attributed FROM clicks"""


def long_indices(categories=CATEGORIES) -> str:
    return " UNION ALL ".join(
        f"SELECT s.event_id, '{c}' AS \"column\", CAST(coalesce(l.idx, (SELECT count(*) FROM labels WHERE col = '{c}')) "
        f"AS DOUBLE) AS label_index FROM test s LEFT JOIN labels l ON l.col = '{c}' AND l.label = CAST(s.{c} AS VARCHAR)"
        for c in categories
    )


INDICES = f"WITH {PARTS}, labels AS ({labels('train')}) {long_indices()}"
FEATURES = f"WITH {PREPARED} {counted('prepared')}"
NULL_KEYS = f"""WITH {PREPARED},
holed AS (SELECT * REPLACE (CASE WHEN os <> 0 THEN ip END AS ip) FROM prepared) {counted('holed')}"""
HOT_IP = f"""WITH {PREPARED},
skewed AS (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN 1 ELSE ip END AS ip) FROM prepared) {counted('skewed')}"""
COUNTS_FROM_TRAIN = f"WITH {PARTS} SELECT t.*, " + ", ".join(
    f"(SELECT count(*) FROM train r WHERE {' AND '.join(f'r.{k} = t.{k}' for k in keys)}) AS {name}"
    for name, keys in GROUPS.items()
) + " FROM test t"

ONE_HOT = (
    f"WITH {PARTS}, seen AS (SELECT * FROM train WHERE app <> 9), labels AS ({labels('seen')}) "
    + " UNION ALL ".join(
        f"SELECT s.event_id, '{c}' AS \"column\", CAST(l.idx AS INT) AS position, CAST(1 AS DOUBLE) AS value FROM test s "
        f"JOIN labels l ON l.col = '{c}' AND l.label = CAST(s.{c} AS VARCHAR)"
        for c in CATEGORIES
    )
)

UNSEEN = f"""WITH {PARTS}, seen AS (SELECT * FROM train WHERE app <> 9), labels AS ({labels('seen', ('app',))})
SELECT event_id, CAST(coalesce(l.idx, (SELECT count(*) FROM labels)) AS DOUBLE) AS "app_Index"
FROM test s LEFT JOIN labels l ON l.label = CAST(s.app AS VARCHAR)"""

# The best split by Gini impurity over the one-hot features: of those with a feature and those without.
STUMP = f"""WITH {PARTS},
labels AS ({labels('train')}),
offsets AS ({offsets()}),
long AS ({entries('train', CATEGORIES, ())}),
sides AS (
  SELECT position, count(*) FILTER (label = 0) AS right_0, count(*) FILTER (label = 1) AS right_1,
         (SELECT count(*) FROM train WHERE label = 0) - count(*) FILTER (label = 0) AS left_0,
         (SELECT count(*) FROM train WHERE label = 1) - count(*) FILTER (label = 1) AS left_1
  FROM long GROUP BY position),
best AS (
  SELECT * FROM sides WHERE left_0 + left_1 > 0
  ORDER BY left_0 * left_1 / (left_0 + left_1) + right_0 * right_1 / (right_0 + right_1), position LIMIT 1)"""


def _gini_split(name: str, where: str) -> str:
    """CTEs ``<name>_rows``, the training clicks of a node, and ``<name>``, its best split by Gini impurity."""
    return f"""{name}_rows AS (SELECT event_id, label FROM train WHERE {where}),
{name}_sides AS (
  SELECT position, count(*) FILTER (label = 0) AS r0, count(*) FILTER (label = 1) AS r1 FROM long
  WHERE event_id IN (SELECT event_id FROM {name}_rows) GROUP BY position),
{name}_whole AS (SELECT count(*) FILTER (label = 0) AS n0, count(*) FILTER (label = 1) AS n1 FROM {name}_rows),
{name} AS (
  -- Leaves beside each other that predict the same class are one.
  SELECT position, CASE WHEN (r1 > r0) = (n1 - r1 > n0 - r0) THEN n1 / (n0 + n1) ELSE r1 / (r0 + r1) END AS present,
    CASE WHEN (r1 > r0) = (n1 - r1 > n0 - r0) THEN n1 / (n0 + n1) ELSE (n1 - r1) / (n0 + n1 - r0 - r1) END AS absent
  FROM {name}_sides, {name}_whole WHERE n0 + n1 > r0 + r1
  ORDER BY r0 * r1 / (r0 + r1) + (n0 - r0) * (n1 - r1) / (n0 + n1 - r0 - r1), position LIMIT 1)"""


def _has(split: str, long: str = "long") -> str:
    return f"event_id IN (SELECT event_id FROM {long} WHERE position = (SELECT position FROM {split}))"


# Each held-out click goes down two levels; a side without a split keeps its share.
TWO_LEVELS = f"""WITH {PARTS},
labels AS ({labels('train')}),
offsets AS ({offsets()}),
long AS (SELECT event_id, label, position FROM ({entries('train', CATEGORIES, ())})),
asked AS (SELECT event_id, position FROM ({entries('test', CATEGORIES, ())})),
{_gini_split('root', 'true')},
{_gini_split('yes', _has('root'))},
{_gini_split('nay', 'NOT ' + _has('root'))}
SELECT event_id, round(CASE
  WHEN {_has('root', 'asked')} THEN CASE WHEN {_has('yes', 'asked')} THEN (SELECT present FROM yes) ELSE (SELECT absent FROM yes) END
  WHEN {_has('nay', 'asked')} THEN (SELECT present FROM nay) ELSE (SELECT absent FROM nay) END, 9) AS score
FROM test"""

def _hashed(c: str, value: str = "{c}") -> tuple[str, str]:
    """A label's position and sign, from the md5 of column and label."""
    digest = f"md5('{c}=' || CAST({value.format(c=c)} AS VARCHAR))"
    return f"(('0x' || substr({digest}, 1, 8))::BIGINT % {HASHED[c]})", f"(CASE WHEN ('0x' || substr({digest}, 9, 1))::INT % 2 = 0 THEN 1 ELSE -1 END)"


def _hashed_features() -> str:
    # A hashed column has as many rows in ``labels`` as it has positions, so that the blocks behind it start where they must.
    listed = [c for c in CATEGORIES if c not in HASHED]
    wide = " UNION ALL ".join(f"SELECT '{c}' AS col, NULL AS label, 0 AS n, unnest(range({w})) AS idx" for c, w in HASHED.items())
    parts = [
        f"SELECT event_id, label, CAST(start + {_hashed(c)[0]} AS INT) AS position, CAST({_hashed(c)[1]} AS DOUBLE) AS value "
        f"FROM test_rows JOIN offsets ON col = '{c}'"
        for c in HASHED
    ]
    return f"""WITH {PARTS}, train_rows AS ({counted('train')}), test_rows AS ({counted('test')}),
labels AS ({labels('train_rows', listed)} UNION ALL {wide}), offsets AS ({offsets()})
{entries('test_rows', listed)} UNION ALL {' UNION ALL '.join(parts)}"""


COLLISIONS = f"WITH {PREPARED}, places AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, {_hashed(c)[0]} AS place, count(DISTINCT {c}) AS labels, count(*) AS n FROM prepared WHERE {c} IS NOT NULL GROUP BY 2"
    for c in HASHED
) + """) SELECT col AS "column", CAST(sum(labels) AS BIGINT) AS labels, CAST(coalesce(sum(labels) FILTER (labels > 1), 0) AS BIGINT) AS shared,
  CAST(coalesce(sum(n) FILTER (labels > 1), 0) AS BIGINT) AS rows_shared FROM places GROUP BY col"""

MERGED = f"""WITH {PREPARED}, labels AS ({labels('prepared')})
SELECT col AS "column", label, n, CAST(idx AS DOUBLE) AS label_index FROM labels"""

MOVED = f"""WITH {PREPARED}, labels AS ({labels('prepared')}),
half AS (SELECT * FROM prepared WHERE {tenth(3)} < 5), old AS ({labels('half')})
SELECT o.col AS "column", CAST(o.idx AS DOUBLE) AS old_index, CAST(l.idx AS DOUBLE) AS new_index
FROM old o JOIN labels l USING (col, label)
UNION ALL
SELECT o.col, CAST(o.n AS DOUBLE), CAST(l.n AS DOUBLE) FROM (SELECT col, count(*) AS n FROM old GROUP BY col) o
JOIN (SELECT col, count(*) AS n FROM labels GROUP BY col) l USING (col)"""

REJECTED = f"""WITH {CLICKS} SELECT CASE WHEN event_id % 50 < 2 THEN 'width' WHEN event_id % 50 < 4 THEN 'type' ELSE 'none' END AS reason,
  count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM clicks GROUP BY 1"""

# Two rounds of one split each: sums of first and second derivatives of the clicks with a feature, and of those without it.
# Logistic loss, margins from the base score on, l2 of 1.
_START = f"ln({BOOSTED['base_score']} / (1 - {BOOSTED['base_score']}))"


def _stump_round(rows: str, number: int) -> str:
    """CTEs ``best<n>``, one row, and ``rows<n + 1>`` with the margins after it, from ``rows``: ``event_id, label, margin``."""
    least = BOOSTED["min_child_weight"]
    return f"""grads{number} AS (
  SELECT event_id, 1 / (1 + exp(-margin)) - label AS g, 1 / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h FROM {rows}),
whole{number} AS (SELECT sum(g) AS sg, sum(h) AS sh FROM grads{number}),
sides{number} AS (
  SELECT position, sum(g) AS rg, sum(h) AS rh FROM long JOIN grads{number} USING (event_id) GROUP BY position),
best{number} AS (
  SELECT position, -(sg - rg) / (sh - rh + 1) * {BOOSTED['eta']} AS absent, -rg / (rh + 1) * {BOOSTED['eta']} AS present
  FROM sides{number}, whole{number} WHERE rh >= {least} AND sh - rh >= {least}
  ORDER BY round((sg - rg) ** 2 / (sh - rh + 1) + rg ** 2 / (rh + 1), 9) DESC, position LIMIT 1),
rows{number + 1} AS (
  SELECT event_id, label, margin + CASE WHEN l.position IS NULL THEN absent ELSE present END AS margin
  FROM {rows} r CROSS JOIN best{number} b LEFT JOIN long l USING (event_id, position))"""


BOOSTED_STUMPS = f"""WITH {PARTS},
labels AS ({labels('train')}),
offsets AS ({offsets()}),
long AS (SELECT event_id, position FROM ({entries('train', CATEGORIES, ())})),
rows0 AS (SELECT event_id, label, {_START} AS margin FROM train),
{_stump_round('rows0', 0)},
{_stump_round('rows1', 1)}
""" + " UNION ALL ".join(
    f"SELECT {i} AS tree, position, round(absent, 9) AS absent, round(present, 9) AS present FROM best{i}" for i in (0, 1)
)

FOLD = f"{tenth(2)} // {10 // FOLDS}"


def rates(source: str, own_fold: bool) -> str:
    """Each click's smoothed rate per category, from the training clicks, or from those in other folds than the click's."""
    others = f"AND t.fold <> s.fold" if own_fold else ""
    base = "(SELECT avg(label) FROM folded t WHERE true " + others + ")"
    parts = [
        f"""SELECT event_id, '{c}' AS "column", round((coalesce(p, 0) + {WEIGHT} * b) / (coalesce(n, 0) + {WEIGHT}), 9) AS rate FROM (
          SELECT s.event_id, (SELECT sum(label) FROM folded t WHERE t.{c} = s.{c} {others}) AS p,
            (SELECT count(*) FROM folded t WHERE t.{c} = s.{c} {others}) AS n, {base} AS b FROM {source} s)"""
        for c in CATEGORIES
    ]
    return f"WITH {PARTS}, folded AS (SELECT *, {FOLD} AS fold FROM train) " + " UNION ALL ".join(parts)


ORACLE = {
    "csv_scan": CSV,
    "csv_scan_inferred": CSV,
    "parquet_scan": f"WITH {ENCODED} SELECT * FROM train_long",
    "partitioned_sink": f"WITH {ENCODED} SELECT * FROM test_long",
    "pipeline_roundtrip": INDICES,
    "unfitted_pipeline": INDICES,
    "pipeline_features": f"WITH {ENCODED} SELECT * FROM test_long",
    # Every leaf of the tree is pure.
    "predictions_csv": f"WITH {PARTS} SELECT label, CAST(label AS DOUBLE) AS score, CAST(label AS DOUBLE) AS prediction FROM test",
    "metric_sink": COUNT_AUROC,
    "time_parts": f"""WITH {CLICKS} SELECT event_id, CAST(hour(click_time) AS INT) AS hour, CAST(day(click_time) AS INT) AS day,
      CAST(minute(click_time) AS INT) AS minute FROM clicks""",
    "click_projection": f"WITH {PREPARED} SELECT * FROM prepared",
    "preview": "SELECT 10 AS known, 10 AS shown",
    "numeric_names": f"WITH {PREPARED}, f AS ({counted('prepared')}) "
    + " UNION ALL ".join(f"SELECT {i} AS place, '{n}' AS name, CAST(sum({n}) AS BIGINT) AS total FROM f" for i, n in enumerate(GROUPS)),
    "split_train": f"WITH {PARTS} SELECT event_id FROM train",
    "split_test": f"WITH {PARTS} SELECT event_id FROM test",
    "random_split_share": "SELECT true AS nine_to_one",
    "random_split": f"WITH {CLICKS} SELECT event_id FROM clicks",
    **{
        f"group_{n.lower()}": f"WITH {PREPARED} SELECT {', '.join(k)}, count(*) AS {n} FROM prepared GROUP BY {', '.join(k)}"
        for n, k in ALL_GROUPS.items()
    },
    **{
        f"count_{n.lower()}": f"WITH {PREPARED} SELECT event_id, {n} FROM ({counted('prepared', {n: k})})"
        for n, k in ALL_GROUPS.items()
    },
    "click_features": FEATURES,
    "click_features_join": FEATURES,
    "click_features_window": FEATURES,
    "click_features_optional": f"WITH {PREPARED} {counted('prepared', ALL_GROUPS)}",
    "click_features_null_keys": NULL_KEYS,
    "click_features_null_keys_join": NULL_KEYS,
    "click_features_null_keys_window": NULL_KEYS,
    "click_features_hot_ip": HOT_IP,
    "click_features_many_hot": FEATURES,
    "click_features_narrow_keys": FEATURES,
    "click_features_counts_from_train": COUNTS_FROM_TRAIN,
    **{
        f"string_index_{c}": f"""WITH {PREPARED}, labels AS ({labels('prepared', (c,))})
          SELECT label, n, CAST(idx AS DOUBLE) AS label_index FROM labels"""
        for c in CATEGORIES
    },
    "string_index_unseen": UNSEEN,
    "index_join": INDICES,
    "one_hot_long": ONE_HOT,
    "feature_rows": f"WITH {ENCODED} SELECT * FROM train_long",
    "held_out_features": f"WITH {ENCODED} SELECT * FROM test_long",
    "label_table_features": f"WITH {ENCODED} SELECT * FROM test_long",
    **{f"{n}_predict_indices": LABEL_AS_PREDICTION for n in ("dt", "rf", "gbt", "boosted")},
    "rf_predict": LABEL_AS_PREDICTION,
    "rf_area": "SELECT true AS ranks",
    "gbt_stump": f"""{STUMP} SELECT position, round((left_1 - left_0) / (left_0 + left_1), 9) AS "left",
      round((right_1 - right_0) / (right_0 + right_1), 9) AS "right" FROM best""",
    "boosted_stumps": BOOSTED_STUMPS,
    "dt_two_levels": TWO_LEVELS,
    "hashed_features": _hashed_features(),
    "hashed_collisions": COLLISIONS,
    "merged_labels": MERGED,
    "moved_labels": MOVED,
    "rejected_lines": REJECTED,
    "train_rates": rates("folded", True),
    "held_out_rates": rates("test", False),
    "dt_predict_rates": LABEL_AS_PREDICTION,
    "boosted_predict_rates": LABEL_AS_PREDICTION,
    "dt_reloaded": f"WITH {PARTS} SELECT label, CAST(label AS DOUBLE) AS prediction, count(*) AS n FROM test GROUP BY label",
    "boosted_gbt_predict_indices": LABEL_AS_PREDICTION,
    **{f"job_chain_{n}": "SELECT CAST(1 AS DOUBLE) AS auroc" for n in ("dt", "gbt", "lr", "rates")},
    "dt_predict": LABEL_AS_PREDICTION,
    "gbt_predict": LABEL_AS_PREDICTION,
    "lr_predict": LABEL_AS_PREDICTION,
    "boosted_predict": LABEL_AS_PREDICTION,
    "tune_lr": LABEL_AS_PREDICTION,
    "nb_model": f"""WITH {ENCODED}, {nb_fit('train_rows', 'train_long', FULL_WIDTH)}
      SELECT CAST(f.label AS DOUBLE) AS label, position, round(pi, 9) AS pi, round(theta, 9) AS theta
      FROM params f JOIN priors p USING (label)""",
    "nb_predict": f"""WITH {ENCODED}, {nb_fit('train_rows', 'train_long', FULL_WIDTH)}, {nb_apply('test_long')}
      SELECT event_id, CAST(prediction AS DOUBLE) AS prediction FROM scored""",
    "tune_nb": f"""WITH {ENCODED},
      learn AS (SELECT * FROM train_rows WHERE {tenth(1)} < 8),
      learn_long AS (SELECT * FROM train_long WHERE {tenth(1)} < 8),
      check_long AS (SELECT * FROM train_long WHERE {tenth(1)} >= 8),
      {nb_fit('learn', 'learn_long', FULL_WIDTH, 'SELECT CAST(unnest([0.0, 0.5, 1.0]) AS DOUBLE) AS s')},
      {nb_apply('check_long')},
      areas AS (SELECT s, {HARD_AUROC} AS area FROM scored GROUP BY s)
      SELECT s AS smoothing, round(area, 9) AS auroc,
             CAST(row_number() OVER (ORDER BY area DESC, s) = 1 AS INT) AS best FROM areas""",
    "auroc_label": f"""WITH {ENCODED}, {nb_fit('train_rows', 'train_long', FULL_WIDTH)}, {nb_apply('test_long')}
      SELECT round({HARD_AUROC}, 9) AS auroc FROM scored""",
    "auroc_score": COUNT_AUROC,
    "job_chain": f"""WITH {ENCODED}, {nb_fit('train_rows', 'train_long', FULL_WIDTH)}, {nb_apply('test_long')}
      SELECT round({HARD_AUROC}, 9) AS auroc FROM scored""",
}
