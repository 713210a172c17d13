"""SQL counterparts of the queries, written independently for an ordinary SQL engine.

Each text starts with the ``births`` view and adds the steps it needs as common table expressions.
"""

from __future__ import annotations

import math
import random
from itertools import combinations

from storkline import schema as S
from storkline.functions import normal
from storkline.plans.queries import (
    BOOSTED, BOXED, CUT_FEATURES, DRIFTED, HALVING_MOST, HALVING_START, PROFILED, STUMP_FEATURES, STUMP_TRIALS, halving_space, stump_space,
)
from storkline.sources.births import BIRTHS_COLUMNS

BIRTHS = "births AS (SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in BIRTHS_COLUMNS.items()) + " FROM lineitem)"

# every raw column after cleaning, in the order of the cleaned frame
CLEAN = """clean AS (
SELECT birth_id, year_fix, month, weight_pounds,
  CASE WHEN plurality <> 0 THEN plurality END AS plurality,
  CAST(CASE lower(trim(is_male)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS TINYINT) AS is_male,
  state, mother_residence_state, mother_birth_state,
  CASE WHEN mother_age < 10 THEN 10 WHEN mother_age > 60 THEN 60 ELSE mother_age END AS mother_age,
  CAST(CASE lower(trim(mother_married)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS TINYINT) AS mother_married,
  CASE WHEN gestation_weeks = 99 THEN NULL WHEN gestation_weeks < 20 THEN 20
    WHEN gestation_weeks > 44 THEN 44 ELSE gestation_weeks END AS gestation_weeks,
  CASE WHEN NOT regexp_matches(trim(lmp), '^9+$') AND trim(lmp) NOT IN ('', 'nan') THEN lmp END AS lmp,
  weight_gain_pounds,
  CAST(CASE lower(trim(cigarette_use)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS TINYINT) AS cigarette_use,
  cigarettes_per_day,
  CAST(CASE lower(trim(alcohol_use)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS TINYINT) AS alcohol_use,
  drinks_per_week, born_alive_alive, born_alive_dead, born_dead, ever_born,
  CASE WHEN father_age <> 99 THEN father_age END AS father_age,
  record_weight, source_year, source_file,
  CAST(0 AS TINYINT) AS outlier_weight,
  round_even(weight_pounds * 453.592e0 * 10e0, 0) / 10e0 AS weight_grams
FROM births WHERE weight_pounds >= 0.66e0 AND weight_pounds <= 15.43e0)"""

FEATURES = """features AS (
SELECT *,
  round_even(weight_gain_pounds * 0.453592e0 * 100e0, 0) / 100e0 AS weight_gain_kg,
  CAST(coalesce(born_alive_alive, 0) + coalesce(born_alive_dead, 0) + coalesce(born_dead, 0) AS SMALLINT) AS parity,
  CAST(coalesce(plurality, 1) > 1 AS TINYINT) AS is_multiple_birth,
  CAST(lmp IS NOT NULL AS TINYINT) AS lmp_known,
  round_even(sin(2e0 * pi() * month / 12e0) * 1000000e0, 0) / 1000000e0 AS birth_month_sin,
  round_even(cos(2e0 * pi() * month / 12e0) * 1000000e0, 0) / 1000000e0 AS birth_month_cos,
  CAST(CASE WHEN mother_age <= 19 THEN 0 WHEN mother_age <= 29 THEN 1 WHEN mother_age <= 39 THEN 2 ELSE 3 END AS TINYINT) AS mother_age_group,
  CAST(coalesce(gestation_weeks, 40) < 37 AS TINYINT) AS gestation_preterm,
  CAST(coalesce(gestation_weeks, 40) > 41 AS TINYINT) AS gestation_post_term
FROM clean)"""

SPLIT = """split AS (
SELECT *, CASE WHEN year_fix >= 2016 THEN 'test' WHEN year_fix >= 2010 THEN 'val' ELSE 'train' END AS split
FROM features)"""

# mean model
MEAN = """scored AS (
SELECT *, (SELECT avg(weight_grams) FROM split WHERE split = 'train') AS prediction FROM split)"""

# ridge with alpha 1 on the standardised, median-filled weeks of gestation
RIDGE = """fill AS (SELECT quantile_cont(gestation_weeks, 0.5) AS f FROM split WHERE split = 'train'),
filled AS (SELECT split.*, coalesce(gestation_weeks, f) AS g FROM split, fill),
scale AS (SELECT avg(g) AS mg, stddev_pop(g) AS sg, avg(weight_grams) AS my FROM filled WHERE split = 'train'),
weight AS (SELECT sum((g - mg) / sg * (weight_grams - my)) / (sum((g - mg) / sg * (g - mg) / sg) + 1e0) AS w
  FROM filled, scale WHERE split = 'train'),
scored AS (SELECT filled.*, my + w * (g - mg) / sg AS prediction FROM filled, scale, weight)"""

LEVELS = {
    "births": [BIRTHS],
    "clean": [BIRTHS, CLEAN],
    "features": [BIRTHS, CLEAN, FEATURES],
    "split": [BIRTHS, CLEAN, FEATURES, SPLIT],
    "mean": [BIRTHS, CLEAN, FEATURES, SPLIT, MEAN],
    "ridge": [BIRTHS, CLEAN, FEATURES, SPLIT, RIDGE],
}


def sql(level: str, body: str, *more: str) -> str:
    return "WITH " + ",\n".join([*LEVELS[level], *more]) + "\n" + body


def each(template: str, names, joiner: str = ", ") -> str:
    return joiner.join(template.replace("@", n) for n in names)


def rows_of(template: str, names) -> str:
    """One SELECT per name, united."""
    return each(template, names, "\nUNION ALL ")


METRICS = """round_even((avg(abs(weight_grams - prediction))) * 1000e0, 0) / 1000e0 AS mae,
  round_even((sqrt(avg((weight_grams - prediction) ** 2))) * 1000e0, 0) / 1000e0 AS rmse,
  round_even((1 - avg((weight_grams - prediction) ** 2) / var_pop(weight_grams)) * 10000e0, 0) / 10000e0 AS r2"""


def clinical(threshold: float, keys: str = "", table: str = "scored") -> tuple[str, str]:
    """A cell-count expression and the rate columns computed from it."""
    cells = f"""count(*) FILTER (weight_grams < {threshold} AND prediction < {threshold}) AS tp,
  count(*) FILTER (weight_grams < {threshold} AND prediction >= {threshold}) AS fn,
  count(*) FILTER (weight_grams >= {threshold} AND prediction < {threshold}) AS fp,
  count(*) FILTER (weight_grams >= {threshold} AND prediction >= {threshold}) AS tn"""
    rates = """round_even((100e0 * (tp + fn) / (tp + fn + fp + tn)) * 100e0, 0) / 100e0 AS lbw_prevalence_pct,
  round_even((CASE WHEN tp + fn > 0 THEN tp * 1e0 / (tp + fn) ELSE 0 END) * 10000e0, 0) / 10000e0 AS sensitivity,
  round_even((CASE WHEN tn + fp > 0 THEN tn * 1e0 / (tn + fp) ELSE 0 END) * 10000e0, 0) / 10000e0 AS specificity,
  round_even((CASE WHEN tp + fp > 0 THEN tp * 1e0 / (tp + fp) ELSE 0 END) * 10000e0, 0) / 10000e0 AS precision,
  round_even((CASE WHEN tp > 0 THEN 2e0 * tp / (2 * tp + fp + fn) ELSE 0 END) * 10000e0, 0) / 10000e0 AS f1,
  tp + fn AS n_lbw_true, tp + fp AS n_lbw_pred"""
    return cells, rates


CONFUSION = """SELECT CASE WHEN weight_grams < 2500 THEN 'LBW' WHEN weight_grams > 4000 THEN 'Macrosomia' ELSE 'Normal' END AS true_class,
  CASE WHEN prediction < 2500 THEN 'LBW' WHEN prediction > 4000 THEN 'Macrosomia' ELSE 'Normal' END AS predicted_class, count(*) AS n FROM @ GROUP BY 1, 2"""


def all_metrics(keys: str, table: str = "scored", where: str = "true") -> str:
    cells, rates = clinical(2500e0)
    lead = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"SELECT {lead}mae, rmse, r2, {rates} FROM (SELECT {lead}{METRICS}, {cells} FROM {table} WHERE {where} {group})"


IN_TRAIN, IN_VAL, IN_TEST = ("split = 'train'", "split = 'val'", "split = 'test'")


def long_of(table: str, columns, lead: str = "", where: str = "true") -> str:
    """CTE body: one row per column and value."""
    return rows_of(f"SELECT {lead}'@' AS feature, CAST(@ AS DOUBLE) AS value FROM {table} WHERE {where}", columns)


HASH = """(((({k} % 2147483647) * 48271 + 42) % 2147483647) * ((({k} % 2147483647) * 48271 + 42) % 2147483647)
  % 2147483647 * 69621 % 2147483647)"""


def key_hash(key: str) -> str:
    return HASH.format(k=key)


def histogram(table: str, columns, bins: int) -> str:
    return sql(
        table,
        f"""SELECT g.feature, g.bin, round_even((low + g.bin * width) * 1000000000e0, 0) / 1000000000e0 AS bin_low, round_even((low + (g.bin + 1) * width) * 1000000000e0, 0) / 1000000000e0 AS bin_high,
  CAST(coalesce(n, 0) AS BIGINT) AS n, round_even((coalesce(n, 0) / (total * width)) * 1000000000e0, 0) / 1000000000e0 AS density
FROM grid g LEFT JOIN filled f ON g.feature = f.feature AND g.bin = f.bin""",
        f"long AS ({long_of(table, columns)})",
        f"""ranges AS (SELECT feature, min(value) AS low, (max(value) - min(value)) / {bins} AS width, count(value) AS total
  FROM long GROUP BY feature)""",
        f"grid AS (SELECT ranges.*, CAST(range AS INT) AS bin FROM ranges, range({bins}))",
        f"""filled AS (SELECT l.feature,
  CAST(CASE WHEN value < low + least(floor((value - low) / width), {bins - 1}) * width THEN least(floor((value - low) / width), {bins - 1}) - 1
    WHEN value >= low + (least(floor((value - low) / width), {bins - 1}) + 1) * width AND floor((value - low) / width) < {bins - 1}
    THEN floor((value - low) / width) + 1
    ELSE least(floor((value - low) / width), {bins - 1}) END AS INT) AS bin, count(*) AS n
  FROM long l JOIN ranges r ON l.feature = r.feature WHERE value IS NOT NULL GROUP BY 1, 2)""",
    )


def kde(table: str, key: str | None, points: int) -> str:
    k = key or "'all'"
    shown = f"c.k AS {key}, " if key else ""
    return sql(
        table,
        f"""SELECT {shown}point, round_even((x) * 1000000e0, 0) / 1000000e0 AS x, round_even((sum(c.n * exp(-0.5e0 * ((x - v) / h) ** 2)) / (total * h * sqrt(2e0 * pi()))) * 1000000000e0, 0) / 1000000000e0 AS density
FROM counts c JOIN grid g ON c.k = g.k GROUP BY c.k, point, x, total, h""",
        f"counts AS (SELECT {k} AS k, weight_grams AS v, count(*) AS n FROM {table} GROUP BY 1, 2)",
        f"""stats AS (SELECT {k} AS k, count(*) AS total, stddev_samp(weight_grams) * count(*) ** (-0.2e0) AS h,
  min(weight_grams) AS lo, max(weight_grams) AS hi FROM {table} GROUP BY 1 HAVING count(*) > 100)""",
        f"""grid AS (SELECT stats.*, CAST(range AS INT) AS point, lo - 0.5e0 * (hi - lo) + range * (2e0 * (hi - lo) / {points - 1}) AS x
  FROM stats, range({points}))""",
    )


def boxes(table: str, columns, key: str, more: tuple[str, ...] = ()) -> str:
    return sql(
        "clean",
        f"""SELECT b.{key}, b.feature, count(*) AS n,
  CAST(count(*) FILTER (NOT (value BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1))) AS BIGINT) AS outliers,
  round_even((q1) * 1000000e0, 0) / 1000000e0 AS q1, round_even((median) * 1000000e0, 0) / 1000000e0 AS median, round_even((q3) * 1000000e0, 0) / 1000000e0 AS q3,
  round_even((least(q1, min(value) FILTER (value >= q1 - 1.5e0 * (q3 - q1)))) * 1000000e0, 0) / 1000000e0 AS whisker_low,
  round_even((greatest(q3, max(value) FILTER (value <= q3 + 1.5e0 * (q3 - q1)))) * 1000000e0, 0) / 1000000e0 AS whisker_high,
  round_even((median - 1.57e0 * (q3 - q1) / sqrt(count(*))) * 1000000e0, 0) / 1000000e0 AS notch_low,
  round_even((median + 1.57e0 * (q3 - q1) / sqrt(count(*))) * 1000000e0, 0) / 1000000e0 AS notch_high
FROM long l JOIN box b ON l.{key} = b.{key} AND l.feature = b.feature
GROUP BY b.{key}, b.feature, q1, median, q3""",
        *more,
        f"long AS (SELECT * FROM ({long_of(table, columns, key + ', ')}) WHERE value IS NOT NULL AND {key} IS NOT NULL)",
        f"""box AS (SELECT {key}, feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM long GROUP BY 1, 2)""",
    )


DESCRIBE = """SELECT feature, count(value) AS n, round_even((avg(value)) * 1000e0, 0) / 1000e0 AS mean, round_even((stddev_samp(value)) * 1000e0, 0) / 1000e0 AS std,
  round_even((min(value)) * 1000e0, 0) / 1000e0 AS min, round_even((quantile_cont(value, 0.25)) * 1000e0, 0) / 1000e0 AS q1, round_even((quantile_cont(value, 0.5)) * 1000e0, 0) / 1000e0 AS median,
  round_even((quantile_cont(value, 0.75)) * 1000e0, 0) / 1000e0 AS q3, round_even((max(value)) * 1000e0, 0) / 1000e0 AS max FROM long GROUP BY feature"""


def shape(column: str, table: str) -> str:
    return f"""SELECT count({column}) AS n, round_even((avg({column})) * 1000000e0, 0) / 1000000e0 AS mean, round_even((median({column})) * 1000000e0, 0) / 1000000e0 AS median,
  round_even((stddev_samp({column})) * 1000000e0, 0) / 1000000e0 AS std, round_even((min({column})) * 1000000e0, 0) / 1000000e0 AS min, round_even((max({column})) * 1000000e0, 0) / 1000000e0 AS max,
  round_even((quantile_cont({column}, 0.25)) * 1000000e0, 0) / 1000000e0 AS q1, round_even((quantile_cont({column}, 0.75)) * 1000000e0, 0) / 1000000e0 AS q3,
  round_even((skewness({column})) * 1000000e0, 0) / 1000000e0 AS skew, round_even((kurtosis({column})) * 1000000e0, 0) / 1000000e0 AS kurtosis FROM {table}"""


def psi_ctes(long: str, group: str, reference: str, bins: int = 10) -> list[str]:
    """PSI of (grp, feature, value, ref) rows."""
    steps = ", ".join(f"{i / bins}" for i in range(1, bins))
    return [
        f"long AS ({long})",
        f"edges AS (SELECT feature, quantile_cont(value, [{steps}]) AS e FROM long WHERE {reference} AND value IS NOT NULL GROUP BY feature)",
        "marks AS (SELECT DISTINCT feature, unnest(e) AS x FROM edges)",
        "counted AS (SELECT grp, feature, ref, value, count(*) AS n FROM long WHERE value IS NOT NULL GROUP BY ALL)",
        "placed AS (SELECT c.grp, c.feature, c.ref, c.value, c.n, count(m.x) AS bin FROM counted c LEFT JOIN marks m ON m.feature = c.feature AND m.x < c.value GROUP BY ALL)",
        "binned AS (SELECT grp, feature, ref, bin, sum(n) AS n FROM placed GROUP BY ALL)",
        "expected AS (SELECT feature, bin, sum(n) FILTER (ref) / sum(sum(n) FILTER (ref)) OVER (PARTITION BY feature) AS e FROM binned GROUP BY feature, bin)",
        "sizes AS (SELECT grp, feature, sum(n) AS total FROM binned GROUP BY grp, feature)",
        "actual AS (SELECT grp, feature, bin, sum(n) AS n FROM binned GROUP BY grp, feature, bin)",
        f"""parts AS (SELECT s.grp, s.feature, greatest(coalesce(x.e, 0), 0.0001e0) AS e, greatest(coalesce(a.n, 0) / s.total, 0.0001e0) AS a
  FROM sizes s JOIN expected x ON s.feature = x.feature LEFT JOIN actual a ON a.grp = s.grp AND a.feature = s.feature AND a.bin = x.bin)""",
        f"psi AS (SELECT feature, grp AS {group}, round_even((sum((a - e) * ln(a / e))) * 1000000e0, 0) / 1000000e0 AS psi, CAST(sum((a - e) * ln(a / e)) > 0.2 AS INT) AS alert FROM parts GROUP BY feature, grp)",
    ]


def split_long(columns) -> str:
    return long_of("split", columns, "split AS grp, split = 'train' AS ref, ")


def nulls(columns, digits: int) -> str:
    return each(f"round_even((avg(CASE WHEN @ IS NULL THEN 1e0 ELSE 0e0 END) * 100e0) * {10 ** digits}e0, 0) / {10 ** digits}e0 AS @", columns)


def row_rules() -> dict[str, str]:
    """What a row that fails a check meets."""
    outside = {
        "target_not_null": "weight_grams IS NULL",
        "target_in_range": "weight_grams < 300 OR weight_grams > 7000",
        "plurality_in_range": "plurality < 1 OR plurality > 9",
        "mother_age_group_in_range": "mother_age_group NOT IN (0, 1, 2, 3)",
        "grams_match_pounds": "abs(weight_grams - weight_pounds * 453.592e0) >= 1",
        "parity_not_negative": "parity < 0",
        "weight_gain_kg_not_negative": "weight_gain_kg < 0",
        "term_flags_exclusive": "gestation_preterm = 1 AND gestation_post_term = 1",
        "year_within_split": "(s.split = 'train' AND year_fix > 2009) OR (s.split = 'val' AND year_fix NOT BETWEEN 2010 AND 2015) OR (s.split = 'test' AND year_fix < 2016)",
        "gestation_weeks_in_range": "gestation_weeks NOT BETWEEN 20 AND 44",
        "mother_age_in_range": "mother_age NOT BETWEEN 10 AND 60",
        "birth_month_sin_in_range": "abs(birth_month_sin) > 1",
        "birth_month_cos_in_range": "abs(birth_month_cos) > 1",
    }
    for name in ("is_male", "mother_married", "gestation_preterm", "gestation_post_term", "is_multiple_birth", "lmp_known"):
        outside[f"{name}_is_flag"] = f"{name} NOT IN (0, 1)"
    return outside


def arrivals() -> str:
    """Violations of each row check over all rows, and how many rows pass all of them."""
    rules = row_rules()
    failed = "(" + " OR ".join(f"coalesce({c}, false)" for c in rules.values()) + ")"
    parts = " UNION ALL ".join(f"SELECT '{n}' AS \"check\", count(*) FILTER ({c}) AS violations FROM split s" for n, c in rules.items())
    return sql("split", f"""SELECT p.*, t.*, 0::BIGINT AS lost FROM ({parts}) p,
  (SELECT count(*) AS rows, count(*) FILTER (NOT {failed}) AS passed, count(*) FILTER ({failed}) AS quarantined FROM split s) t""")


def expectations() -> str:
    """Violations per check and split, for the checks that look at rows; schema checks are constants."""
    outside = row_rules()
    parts = [f"SELECT '{n}' AS \"check\", s.split, count(*) FILTER ({c}) AS violations FROM split s GROUP BY s.split" for n, c in outside.items()]
    parts += [f"SELECT '{n}', split, 0 FROM split GROUP BY split" for n in ("required_columns", "no_leakage_columns", "same_columns", "split_not_empty")]
    parts += [
        "SELECT 'train_share', 'train', CAST(count(*) FILTER (split = 'train') * 2 < count(*) AS BIGINT) FROM split",
        "SELECT 'target_mean_plausible', 'train', CAST(avg(weight_grams) NOT BETWEEN 2800 AND 3800 AS BIGINT) FROM split WHERE split = 'train'",
        "SELECT 'lbw_rate_plausible', 'train', CAST(100 * avg(CAST(weight_grams < 2500 AS INT)) NOT BETWEEN 3 AND 20 AS BIGINT) FROM split WHERE split = 'train'",
        "SELECT 'all_files_present', 'train', CAST(count(DISTINCT source_file) <> 5 AS BIGINT) FROM split",
    ]
    return sql("split", f"SELECT *, CAST(violations = 0 AS INT) AS passed FROM ({' UNION ALL '.join(parts)})")


def impute_ctes() -> list[str]:
    median = rows_of("SELECT '@' AS feature, 'median' AS strategy, CAST(quantile_cont(@, 0.5) AS DOUBLE) AS fill FROM split WHERE split = 'train'", S.NUMERIC_FEATURES)
    mode = rows_of("SELECT '@', 'most_frequent', CAST((SELECT @ FROM split WHERE split = 'train' AND @ IS NOT NULL GROUP BY @ ORDER BY count(*) DESC, @ LIMIT 1) AS DOUBLE)", S.BINARY_FEATURES)
    return [f"fills AS ({median} UNION ALL {mode})"]


def fill_of(column: str) -> str:
    return f"(SELECT fill FROM fills WHERE feature = '{column}')"


STUMP_COLUMNS = sum(STUMP_FEATURES, [])


def stump_ctes(least: int = 1, name: str = "stump") -> list[str]:
    """A tree of one split: every cut of every filled feature is tried on the training rows."""
    chosen = "CASE feature " + each("WHEN '@' THEN @", STUMP_COLUMNS, " ") + " END"
    return [
        f"{name}_rows AS (SELECT split, weight_grams, " + ", ".join(f"CAST(coalesce({c}, {fill_of(c)}) AS DOUBLE) AS {c}" for c in STUMP_COLUMNS) + " FROM split)",
        f"{name}_values AS (" + rows_of(f"SELECT '@' AS feature, @ AS v, count(*) AS n, sum(weight_grams) AS s FROM {name}_rows WHERE split = 'train' GROUP BY @", STUMP_COLUMNS) + ")",
        f"""{name}_cuts AS (SELECT feature, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY feature) AS nt, sum(s) OVER (PARTITION BY feature) AS st
  FROM {name}_values WINDOW w AS (PARTITION BY feature ORDER BY v))""",
        f"""{name}_best AS (SELECT feature, v, sl / nl AS low, (st - sl) / (nt - nl) AS high FROM {name}_cuts WHERE nl >= {least} AND nt - nl >= {least}
  ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)""",
        f"{name} AS (SELECT r.*, CASE WHEN {chosen} <= v THEN low ELSE high END AS prediction FROM {name}_rows r, {name}_best)",
    ]


def stump_trials() -> str:
    """Trials and the best of them, the parameters drawn as the search draws them."""
    draw = random.Random(42)
    least = [stump_space(draw)["min_child_samples"] for _ in range(STUMP_TRIALS)]
    trials = " UNION ALL ".join(
        f"SELECT 'stumps_trial_{i}' AS run_name, {i} AS i, '{m}' AS min_child_samples, mae AS val_mae FROM ({all_metrics('', f't{i}', IN_VAL)})"
        for i, m in enumerate(least))
    ctes = [cte for i, m in enumerate(least) for cte in stump_ctes(m, f"t{i}")]
    return sql("split", f"""SELECT run_name, min_child_samples, val_mae FROM trials
UNION ALL SELECT * FROM (SELECT 'stumps_{STUMP_TRIALS}_trials', min_child_samples, val_mae FROM trials ORDER BY val_mae, i LIMIT 1)""",
        *impute_ctes(), *ctes, f"trials AS ({trials})")


CUT_COLUMNS = sum(CUT_FEATURES, [])
CUT_VALUE = "CASE feature " + each("WHEN '@' THEN @", CUT_COLUMNS, " ") + " END"


def filled_rows(name: str) -> str:
    """The filled features of the trees next to target and split."""
    columns = ", ".join(f"CAST(coalesce({c}, {fill_of(c)}) AS DOUBLE) AS {c}" for c in CUT_COLUMNS)
    return f"{name} AS MATERIALIZED (SELECT birth_id, split, CAST(weight_grams AS DOUBLE) AS y, {columns} FROM split)"


def best_cut(name: str, rows: str, target: str, least: int = 1, where: str = "true") -> list[str]:
    """``{name}(feature, v, low, high, nl, nr)``: the cut of the training rows that leaves the least squared error."""
    return [
        f"{name}_values AS MATERIALIZED (" + rows_of(f"SELECT '@' AS feature, @ AS v, count(*) AS n, sum({target}) AS s FROM {rows} WHERE split = 'train' AND {where} GROUP BY @", CUT_COLUMNS) + ")",
        f"""{name}_cuts AS (SELECT feature, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER (PARTITION BY feature) AS nt, sum(s) OVER (PARTITION BY feature) AS st
  FROM {name}_values WINDOW w AS (PARTITION BY feature ORDER BY v))""",
        f"""{name} AS MATERIALIZED (SELECT feature, v, sl / nl AS low, (st - sl) / (nt - nl) AS high, nl, nt - nl AS nr FROM {name}_cuts WHERE nl >= {least} AND nt - nl >= {least}
  ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)""",
    ]


def boosted_ctes(name: str, rounds: int, rate: float, least: int = 1) -> list[str]:
    """Stumps fitted one after the other on twice the errors so far; ``{name}_errors`` has a row for every number of them."""
    out = []
    for r in range(1, rounds + 1):
        rows = "tree_rows" if r == 1 else f"{name}_p{r - 1}"
        out += best_cut(f"{name}_c{r}", rows, "y" if r == 1 else "2 * (y - p)", least)
        value = f"CASE WHEN {CUT_VALUE} <= v THEN low ELSE high END"
        prediction = value if r == 1 else f"p + {rate!r}e0 * {value}"
        columns = ", ".join(f"r.{c}" for c in ["split", "y", *CUT_COLUMNS])
        out.append(f"{name}_p{r} AS MATERIALIZED (SELECT {columns}, {prediction} AS p FROM {rows} r, {name}_c{r})")
    error = """SELECT {r} AS trees, count(*) AS n, round_even(avg(abs(y - p)) * 1000e0, 0) / 1000e0 AS mae,
  round_even(sqrt(avg((y - p) * (y - p))) * 1000e0, 0) / 1000e0 AS rmse FROM {name}_p{r} WHERE split = 'val'"""
    errors = "\nUNION ALL ".join(error.format(r=r, name=name) for r in range(1, rounds + 1))
    return [*out, f"{name}_errors AS MATERIALIZED ({errors})"]


def boosted_scored() -> str:
    """Predictions of the prefix that early stopping keeps."""
    n = BOOSTED["n_estimators"]
    parts = "\nUNION ALL ".join(f"SELECT {r} AS trees, split, y AS weight_grams, p AS prediction FROM b_p{r}" for r in range(1, n + 1))
    return f"stopped AS (SELECT * FROM ({parts}) WHERE trees = (SELECT trees FROM b_errors ORDER BY mae, trees LIMIT 1))"


def halving() -> str:
    """Every trial grown as far as any may grow; the rounds pick from their errors."""
    space = halving_space()
    ctes = [c for i, p in enumerate(space) for c in boosted_ctes(f"h{i}", HALVING_MOST, p["learning_rate"], p["min_child_samples"])]
    ctes.append("errors AS (" + " UNION ALL ".join(f"SELECT {i} AS trial, trees AS t, mae FROM h{i}_errors" for i in range(len(space))) + ")")
    alive, count, trees, number, rounds = "errors", len(space), HALVING_START, 0, []
    while True:
        last = count == 1 or trees == HALVING_MOST
        left = 1 if last else min(-(-count // 2), count - 1)
        ctes.append(f"""round{number} AS MATERIALIZED (SELECT *, CAST(row_number() OVER (ORDER BY val_mae, trial) <= {left} AS INT) AS survived FROM (
  SELECT {number} AS round, trial, {trees} AS trees, arg_min(t, (mae, t)) AS best_trees, min(mae) AS val_mae FROM {alive} WHERE t <= {trees} GROUP BY trial))""")
        ctes.append(f"alive{number} AS (SELECT e.* FROM errors e JOIN round{number} r ON e.trial = r.trial AND r.survived = 1)")
        rounds.append(f"SELECT round, trial, trees, CAST(best_trees AS INT) AS best_trees, val_mae, survived FROM round{number}")
        if last:
            return sql("split", " UNION ALL ".join(rounds), *impute_ctes(), filled_rows("tree_rows"), *ctes)
        alive, trees, count, number = f"alive{number}", min(-(-trees * count // left), HALVING_MOST), left, number + 1


def tree_shapley() -> str:
    """Shapley values of a tree of two levels by their definition: worth of every set of features, weighted by its size."""
    n = len(CUT_COLUMNS)
    bit = "CASE feature " + " ".join(f"WHEN '{c}' THEN {1 << i}" for i, c in enumerate(CUT_COLUMNS)) + " END"
    known = {k: f"(mask & {bit.replace('feature', f'{k}.feature')}) > 0" for k in ("a", "l", "r")}
    value = {k: CUT_VALUE.replace("CASE feature", f"CASE {k}.feature") for k in ("a", "l", "r")}

    def worth(k: str, low: str, high: str) -> str:
        mean = f"({k}.nl * {low} + {k}.nr * {high}) / ({k}.nl + {k}.nr)"
        return f"(CASE WHEN {known[k]} THEN CASE WHEN {value[k]} <= {k}.v THEN {low} ELSE {high} END ELSE {mean} END)"

    whole = worth("a", worth("l", "l.low", "l.high"), worth("r", "r.low", "r.high"))
    factorials = "[" + ", ".join(str(math.factorial(k)) + "e0" for k in range(n + 1)) + "]"
    size, f = "bit_count(mask)", "f.f"
    inside = f"{f}[{size}] * {f}[{n} - {size} + 1]"
    outside = f"{f}[{size} + 1] * {f}[{n} - {size}]"
    weight = f"(CASE WHEN (mask & b) > 0 THEN {inside} ELSE -({outside}) END) / {f}[{n + 1}]"
    left = f"({CUT_VALUE.replace('CASE feature', 'CASE (SELECT feature FROM a)')} <= (SELECT v FROM a))"
    bits = ", ".join(f"('{c}', {1 << i})" for i, c in enumerate(CUT_COLUMNS))
    return sql(
        "split", "SELECT feature, round_even(avg(abs(phi)) * 10000e0, 0) / 10000e0 AS mean_abs FROM values_ GROUP BY feature",
        *impute_ctes(), filled_rows("tree_rows"), *best_cut("a", "tree_rows", "y"),
        *best_cut("l", "tree_rows", "y", where=left), *best_cut("r", "tree_rows", "y", where=f"NOT {left}"),
        f"worths AS (SELECT row_number() OVER () AS row, t.* FROM tree_rows t WHERE split = 'val')",
        f"masked AS MATERIALIZED (SELECT row, mask, {whole} AS worth FROM worths, (SELECT range AS mask FROM range({1 << n})), a, l, r)",
        f"values_ AS (SELECT row, feature, sum({weight} * worth) AS phi FROM masked, (VALUES {bits}) q(feature, b), (SELECT {factorials} AS f) f GROUP BY row, feature)",
    )


def horner(x: str, coefficients: list[float]) -> str:
    out = f"{coefficients[0]!r}"
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


def normal_quantile(p: str) -> str:
    """The published approximation AS 241 as SQL."""
    def part(x: str, region) -> str:
        return f"{horner(x, region[0])} / {horner(x, region[1])}"

    r = f"sqrt(-ln(least({p}, 1e0 - {p})))"
    return f"""CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN ({p} - 0.5e0) * {part(f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))', normal.CENTRE)}
  WHEN {r} <= 5e0 THEN sign({p} - 0.5e0) * {part(f'({r} - 1.6e0)', normal.SHOULDER)} ELSE sign({p} - 0.5e0) * {part(f'({r} - 5e0)', normal.TAIL)} END"""


QQ = [
    "numbered AS (SELECT weight_grams AS ordered, row_number() OVER (ORDER BY weight_grams) AS r, count(*) OVER () AS m FROM clean)",
    "shown AS (SELECT k AS i, (k - 1) * (m - 1) // greatest(least(m, 5000) - 1, 1) + 1 AS r FROM (SELECT max(m) AS m FROM numbered), range(1, 5001) t(k) WHERE k <= m)",
    "levels AS (SELECT i, ordered, CASE WHEN r = m THEN 0.5e0 ** (1e0 / m) WHEN r = 1 THEN 1e0 - 0.5e0 ** (1e0 / m) ELSE (r - 0.3175e0) / (m + 0.365e0) END AS p FROM numbered JOIN shown USING (r))",
    f"points AS (SELECT i, ordered, {normal_quantile('p')} AS z FROM levels)",
]
RANKED_COLUMNS = S.CORRELATION_COLUMNS[1:]


def ranked(columns, where: str = "r IS NOT NULL", limit: int = 15) -> str:
    rows = rows_of("SELECT '@' AS feature, corr(CAST(@ AS DOUBLE), weight_grams) AS r FROM features", columns)
    return sql("features", f"SELECT feature, round_even((r) * 1000000e0, 0) / 1000000e0 AS r FROM ({rows}) WHERE {where} ORDER BY abs(r) DESC, feature LIMIT {limit}")


LINES = rows_of(
    "SELECT '@' AS model, round_even((avg(abs(weight_grams - (a + b * @)))) * 1000e0, 0) / 1000e0 AS val_mae FROM split, "
    "(SELECT round_even((regr_slope(weight_grams, @)) * 1000000000e0, 0) / 1000000000e0 AS b, round_even((regr_intercept(weight_grams, @)) * 1000000000e0, 0) / 1000000000e0 AS a FROM split WHERE split = 'train') "
    "WHERE split = 'val' AND @ IS NOT NULL",
    S.NUMERIC_FEATURES,
)
SPLIT_ROWS = """SELECT split, count(*) AS n_rows, round_even((100e0 * count(*) / (SELECT count(*) FROM split)) * 10e0, 0) / 10e0 AS pct,
  min(year_fix) AS year_min, max(year_fix) AS year_max"""
SUBGROUPS = {
    "sex": "is_male", "age_group": "mother_age_group",
    "gestation": "CASE WHEN gestation_weeks < 37 THEN 'preterm' WHEN gestation_weeks > 41 THEN 'post-term' WHEN gestation_weeks IS NOT NULL THEN 'term' END",
    "year": "year_fix", "state": "state",
}
RISK = "CASE WHEN @ <= 1500 THEN 'VLBW' WHEN @ <= 2500 THEN 'LBW' WHEN @ <= 4000 THEN 'Normal' ELSE 'Macrosomia' END AS risk, CAST(@ BETWEEN 2400 AND 2600 AS TINYINT) AS near_limit"
DUPLICATE_COLUMNS = "month, weight_pounds, plurality, is_male, state, mother_age, gestation_weeks"


def oracle_sql() -> dict[str, str]:
    all_births = list(BIRTHS_COLUMNS)
    raw = ", ".join(S.RAW_COLUMNS)
    clean_columns = [c for c in all_births if c not in S.LEAKAGE_COLUMNS] + ["outlier_weight", "weight_grams"]
    feature_columns = [c for c in clean_columns + S.ENGINEERED_COLUMNS if c not in S.NON_FEATURE_COLUMNS]
    cells, rates = clinical(3600e0)
    bins = 10
    value_bin = f"CAST(greatest(0, least({bins - 1}, floor(value * {bins} / 200e0))) AS INT)"
    out = {
        "split_summary": sql("split", SPLIT_ROWS + ", round_even((100 * avg(CAST(weight_grams < 2500 AS INT))) * 100e0, 0) / 100e0 AS lbw_pct FROM split GROUP BY split"),
        "tag_source_year": sql("births", "SELECT birth_id, source_file, CAST(right(source_file, 4) AS INT) AS source_year FROM births"),
        "load_all": sql("births", f"""SELECT source_file, count(*) AS n_rows, min(source_year) AS source_year,
  {each('count(@) AS known_@', S.RAW_COLUMNS)}, round_even((sum(weight_pounds)) * 10000e0, 0) / 10000e0 AS sum_weight_pounds,
  round_even((sum(gestation_weeks)) * 10000e0, 0) / 10000e0 AS sum_gestation_weeks, CAST(sum(length(lmp)) AS BIGINT) AS lmp_chars FROM births GROUP BY source_file"""),
        "scan_csv": sql("births", f"SELECT source_year, {raw} FROM births WHERE source_year = 2002"),
        "skip_bad_lines": sql("births", "SELECT year_fix, month, count(*) AS n, count(*) FILTER (apgar_1min <> 6) AS n_state FROM births WHERE apgar_1min <> 7 GROUP BY 1, 2"),
        "save_splits": sql("split", "SELECT split, count(*) AS n_rows, round_even(sum(weight_grams) * 10e0, 0) / 10e0 AS sum_grams, CAST(sum(parity) AS BIGINT) AS sum_parity FROM split GROUP BY split"),
        "verify_reload": sql("split", "SELECT split, count(*) AS n_rows, 1 AS rows_match, 1 AS columns_match FROM split GROUP BY split"),
        "read_pruned": sql("split", f"""SELECT count(*) AS n_rows, {each('count(@) AS known_@', S.MODEL_FEATURES)},
  round_even((avg(CAST(CAST(weight_grams AS FLOAT) AS DOUBLE))) * 1000e0, 0) / 1000e0 AS mean_grams, round_even((avg(gestation_weeks)) * 1000000e0, 0) / 1000000e0 AS mean_gestation
  FROM split WHERE split = 'val'"""),
        # cleaning
        "drop_leakage": sql("births", "SELECT * EXCLUDE (apgar_1min, apgar_5min, day) FROM births"),
        "cast_booleans": sql("births", "SELECT birth_id, " + each("CAST(CASE lower(trim(@)) WHEN 'true' THEN 1 WHEN 'false' THEN 0 END AS TINYINT) AS @", S.BOOLEAN_COLUMNS) + " FROM births"),
        "null_sentinel": sql("births", "SELECT birth_id, nullif(father_age, 99) AS father_age, nullif(gestation_weeks, 99) AS gestation_weeks, nullif(plurality, 0) AS plurality FROM births"),
        "null_unknown_lmp": sql("births", "SELECT birth_id, CASE WHEN lmp IN ('99', '9999') THEN NULL ELSE lmp END AS lmp FROM births"),
        "clip_ranges": sql("births", """SELECT birth_id, CASE WHEN gestation_weeks = 99 THEN NULL WHEN gestation_weeks < 20 THEN 20 WHEN gestation_weeks > 44 THEN 44 ELSE gestation_weeks END AS gestation_weeks,
  CASE WHEN mother_age < 10 THEN 10 WHEN mother_age > 60 THEN 60 ELSE mother_age END AS mother_age FROM births"""),
        "flag_outlier_weight": sql("births", "SELECT birth_id, weight_pounds, CAST(CASE WHEN weight_pounds NOT BETWEEN 0.66e0 AND 15.43e0 THEN 1 ELSE 0 END AS TINYINT) AS outlier_weight FROM births"),
        "convert_target": sql("births", "SELECT birth_id, weight_pounds, round_even(weight_pounds * 453.592e0 * 10e0, 0) / 10e0 AS weight_grams FROM births"),
        "drop_invalid_target": sql("births", "SELECT birth_id, weight_pounds FROM births WHERE weight_pounds BETWEEN 0.66e0 AND 15.43e0"),
        "run_preprocessing": sql("clean", "SELECT * FROM clean"),
        "cleaning_counts": sql("births", """SELECT *, round_even((100e0 * (rows_in - rows_out) / rows_in) * 100e0, 0) / 100e0 AS removed_pct FROM (SELECT count(*) AS rows_in,
  count(*) FILTER (father_age = 99) AS father_age_sentinels, count(*) FILTER (gestation_weeks = 99) AS gestation_weeks_sentinels,
  count(*) FILTER (plurality = 0) AS plurality_sentinels, count(*) FILTER (lmp IS NULL OR lmp IN ('99', '9999')) AS lmp_unknown,
  count(*) FILTER (gestation_weeks <> 99 AND gestation_weeks NOT BETWEEN 20 AND 44) AS gestation_weeks_capped,
  count(*) FILTER (mother_age NOT BETWEEN 10 AND 60) AS mother_age_capped,
  count(*) FILTER (weight_pounds NOT BETWEEN 0.66e0 AND 15.43e0) AS weight_outliers,
  count(*) FILTER (weight_pounds IS NULL) AS weight_missing,
  count(*) FILTER (weight_pounds BETWEEN 0.66e0 AND 15.43e0) AS rows_out,
  round_even((avg(round_even(weight_pounds * 453.592e0 * 10e0, 0) / 10e0)) * 10e0, 0) / 10e0 AS grams_mean,
  round_even((stddev_samp(round_even(weight_pounds * 453.592e0 * 10e0, 0) / 10e0)) * 10e0, 0) / 10e0 AS grams_std FROM births)"""),
        "filter_by_value": sql("clean", "SELECT birth_id, is_male, weight_grams FROM clean WHERE is_male = 1"),
        # features
        "weight_gain_kg": sql("features", "SELECT birth_id, weight_gain_pounds, weight_gain_kg FROM features"),
        "parity": sql("features", "SELECT birth_id, born_alive_alive, born_alive_dead, born_dead, parity FROM features"),
        "is_multiple_birth": sql("features", "SELECT birth_id, plurality, is_multiple_birth FROM features"),
        "lmp_known": sql("features", "SELECT birth_id, lmp, lmp_known FROM features"),
        "cyclical_month": sql("features", "SELECT birth_id, month, birth_month_sin, birth_month_cos FROM features"),
        "mother_age_group": sql("features", "SELECT birth_id, mother_age, mother_age_group FROM features"),
        "gestation_flags": sql("features", "SELECT birth_id, gestation_weeks, gestation_preterm, gestation_post_term FROM features"),
        "engineer_features": sql("features", "SELECT * FROM features"),
        "weight_category": sql("births", """SELECT birth_id, g AS weight_grams,
  CASE WHEN g <= 0 OR g > 9999 THEN NULL WHEN g <= 1500 THEN 'VLBW' WHEN g <= 2500 THEN 'LBW' WHEN g <= 4000 THEN 'Normal' WHEN g <= 9999 THEN 'Macrosomia' END AS finite_category,
  CASE WHEN g <= 1500 THEN 'VLBW' WHEN g <= 2500 THEN 'LBW' WHEN g <= 4000 THEN 'Normal' WHEN g > 4000 THEN 'Macrosomia' END AS open_category
  FROM (SELECT birth_id, round_even(weight_pounds * 453.592e0 * 10e0, 0) / 10e0 AS g FROM births)"""),
        "derive_all_new_cols": sql("features", DESCRIBE, f"long AS ({long_of('features', S.ENGINEERED_COLUMNS)})"),
        # split and selection
        "temporal_split": sql("split", "SELECT birth_id, year_fix, split FROM split"),
        "split_info": sql("split", SPLIT_ROWS + " FROM split GROUP BY split"),
        "get_xy": sql("split", f"SELECT {', '.join(feature_columns)}, weight_grams FROM split WHERE split = 'test'"),
        "model_matrix": sql("split", "SELECT birth_id, split, " + each("CAST(@ AS DOUBLE) AS @", S.MODEL_FEATURES) + ", weight_grams FROM split"),
        "feature_profile": sql("features", rows_of("SELECT '@' AS feature, round_even((avg(CASE WHEN @ IS NULL THEN 1e0 ELSE 0e0 END) * 100e0) * 10e0, 0) / 10e0 AS missing_pct FROM features", feature_columns)),
        # profiling
        "data_summary": sql("births", f"""SELECT count(*) AS n_rows, 28 AS n_cols, string_agg(DISTINCT source_file, ',' ORDER BY source_file) AS files_included,
  min(year_fix) AS year_min, max(year_fix) AS year_max,
  {each('round_even((avg(CASE WHEN @ IS NULL THEN 1e0 ELSE 0e0 END) * 100e0) * 100e0, 0) / 100e0 AS missing_@', all_births[1:])} FROM births"""),
        "file_year_ranges": sql("births", "SELECT source_file, count(*) AS n_rows, min(year_fix) AS year_min, max(year_fix) AS year_max, count(DISTINCT year_fix) AS n_years FROM births GROUP BY source_file"),
        "file_row_share": sql("births", "SELECT source_file, count(*) AS row_count, round_even((count(*) * 1e0 / (SELECT count(*) FROM births) * 100e0) * 10e0, 0) / 10e0 AS pct FROM births GROUP BY source_file"),
        "describe_numeric": sql("births", DESCRIBE, f"long AS ({long_of('births', PROFILED)})"),
        "target_stats": sql("clean", shape("weight_grams", "clean")),
        "category_prevalence": sql("clean", """SELECT round_even((100 * avg(CAST(weight_grams < 1500 AS INT))) * 100e0, 0) / 100e0 AS vlbw_pct, round_even((100 * avg(CAST(weight_grams < 2500 AS INT))) * 100e0, 0) / 100e0 AS lbw_pct,
  round_even((100 * avg(CAST(weight_grams >= 2500 AND weight_grams <= 4000 AS INT))) * 100e0, 0) / 100e0 AS normal_pct, round_even((100 * avg(CAST(weight_grams > 4000 AS INT))) * 100e0, 0) / 100e0 AS macrosomia_pct FROM clean"""),
        "category_counts": sql("clean", """SELECT position, category, count(weight_grams) AS n, round_even((count(weight_grams) * 1e0 / (SELECT count(*) FROM clean) * 100e0) * 10e0, 0) / 10e0 AS pct
  FROM (VALUES (0, 'VLBW', -1e9, 1500e0), (1, 'LBW', 1500e0, 2500e0), (2, 'Normal', 2500e0, 4000e0), (3, 'Macrosomia', 4000e0, 1e9)) v(position, category, lo, hi)
  LEFT JOIN clean ON weight_grams > lo AND weight_grams <= hi GROUP BY position, category"""),
        "value_counts": sql("clean", f"SELECT feature, value, count(*) AS n FROM ({long_of('clean', ['is_male', 'mother_married', 'plurality', 'record_weight'])}) GROUP BY feature, value"),
        "missing_pct": sql("births", "SELECT * FROM (" + rows_of("SELECT '@' AS feature, count(*) - count(@) AS missing_count, round_even(((count(*) - count(@)) * 1e0 / count(*) * 100e0) * 100e0, 0) / 100e0 AS missing_pct FROM births", all_births) + ") WHERE missing_count > 0"),
        "missing_by_file": sql("births", f"SELECT source_file, {nulls(S.KEY_MISSING_COLUMNS, 1)} FROM births GROUP BY source_file"),
        "missing_patterns": sql("births", "SELECT " + each("CASE WHEN @ IS NULL THEN '1' ELSE '0' END", S.RAW_COLUMNS, " || ") + " AS pattern, count(*) AS n FROM births GROUP BY 1"),
        "completeness": sql("clean", rows_of("SELECT '@' AS feature, count(@) AS known, round_even((count(@) * 1e0 / count(*) * 100e0) * 100e0, 0) / 100e0 AS known_pct FROM clean", clean_columns)),
        "schema_profile": sql("births", rows_of("SELECT '@' AS feature, round_even(((count(*) - count(@)) * 1e0 / count(*) * 100e0) * 10e0, 0) / 10e0 AS null_pct FROM births", all_births)),
        "corr_matrix": sql("features", "\nUNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round_even((corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) * 1000000e0, 0) / 1000000e0 AS r FROM features" for a, b in combinations(S.CORRELATION_COLUMNS, 2))),
        "corr_ranked": ranked(S.MODEL_FEATURES),
        "corr_positive": ranked(RANKED_COLUMNS, "r > 0", 5),
        "corr_negative": ranked(RANKED_COLUMNS, "r < 0", 5),
        "leakage_corr": sql("births", rows_of("SELECT '@' AS feature, round_even((corr(@, weight_pounds * 453.592e0)) * 1000000e0, 0) / 1000000e0 AS r FROM births", S.APGAR_COLUMNS)),
        "point_biserial": sql("features", rows_of("SELECT '@' AS feature, round_even((corr(CAST(@ AS DOUBLE), weight_grams)) * 1000000e0, 0) / 1000000e0 AS r, round_even((avg(weight_grams) FILTER (@ = 0)) * 1000000e0, 0) / 1000000e0 AS mean_0, round_even((avg(weight_grams) FILTER (@ = 1)) * 1000000e0, 0) / 1000000e0 AS mean_1 FROM features", ["is_male", "mother_married", "is_multiple_birth"])),
        "trend_line": sql("features", rows_of("SELECT '@' AS feature, round_even((regr_slope(weight_grams, @)) * 1000000e0, 0) / 1000000e0 AS slope, round_even((regr_intercept(weight_grams, @)) * 1000000e0, 0) / 1000000e0 AS intercept, CAST(regr_count(weight_grams, @) AS BIGINT) AS n FROM features", [*BOXED, "father_age"])),
        "lbw_rate": sql("clean", "SELECT round_even((100 * avg(CAST(weight_grams < 2500 AS INT))) * 100e0, 0) / 100e0 AS lbw_pct FROM clean"),
        "yearly_trend": sql("features", """SELECT year_fix, count(*) AS n, round_even((avg(weight_grams)) * 1000000e0, 0) / 1000000e0 AS mean, round_even((median(weight_grams)) * 1000000e0, 0) / 1000000e0 AS median, round_even((stddev_samp(weight_grams)) * 1000000e0, 0) / 1000000e0 AS std,
  round_even((100 * avg(CAST(weight_grams < 2500 AS INT))) * 1000000e0, 0) / 1000000e0 AS lbw_pct, round_even((100 * avg(gestation_preterm)) * 1000000e0, 0) / 1000000e0 AS preterm_pct FROM features GROUP BY year_fix"""),
        "histogram": histogram("features", [S.TARGET], 80),
        "feature_histograms": histogram("features", S.NUMERIC_FEATURES[:9], 40),
        "kde": kde("clean", None, 1000),
        "kde_by_era": kde("clean", "source_year", 200),
        "kde_by_split": kde("split", "split", 200),
        "box_stats": boxes("clean", [S.TARGET], "is_male"),
        "box_stats_by_category": boxes("labelled", BOXED, "weight_category", (f"labelled AS (SELECT *, CASE WHEN weight_grams <= 1500 THEN 'VLBW' WHEN weight_grams <= 2500 THEN 'LBW' WHEN weight_grams <= 4000 THEN 'Normal' ELSE 'Macrosomia' END AS weight_category FROM clean)",)),
        "qq_points": sql("clean", "SELECT CAST(i AS INT) AS i, round_even(z * 1000000e0, 0) / 1000000e0 AS theoretical, ordered FROM points", *QQ),
        "qq_line": sql("clean", """SELECT round_even(regr_slope(ordered, z) * 100000e0, 0) / 100000e0 AS slope,
  round_even(regr_intercept(ordered, z) * 100000e0, 0) / 100000e0 AS intercept, round_even(corr(ordered, z) * 100000e0, 0) / 100000e0 AS r FROM points""", *QQ),
        # ordering, sampling, set operations
        "sort_metric": sql("split", LINES),
        "top_k": sql("split", f"SELECT * FROM ({LINES}) ORDER BY val_mae LIMIT 6"),
        "argmin_model": sql("split", f"SELECT * FROM ({LINES}) ORDER BY val_mae LIMIT 1"),
        "sample_n": sql("clean", f"SELECT birth_id, weight_grams FROM clean ORDER BY {key_hash('birth_id')}, birth_id LIMIT 5000"),
        "limit_per_file": sql("births", "SELECT source_file, year_fix, month, weight_pounds, mother_age, lmp, state FROM births QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY birth_id) <= 1000"),
        "peek_raw": sql("births", """SELECT birth_id, year_fix, state, lmp, CAST(1 AS INT) AS header FROM first
UNION ALL SELECT birth_id, year_fix, state, lmp, 0 FROM first WHERE n < 5 UNION ALL SELECT 'birth_id', 'year_fix', 'state', 'lmp', 0""",
            "first AS (SELECT CAST(birth_id AS VARCHAR) AS birth_id, CAST(year_fix AS VARCHAR) AS year_fix, state, lmp, row_number() OVER (ORDER BY births.birth_id) AS n FROM births WHERE source_year = 2002 QUALIFY n <= 5)"),
        "column_set_diff": sql("features", "\nUNION ALL ".join(
            rows_of(f"SELECT '@' AS \"column\", count(@) AS n_known, '{side}' AS only_in FROM {table}", names)
            for side, table, names in (("raw", "births", ["day", *S.APGAR_COLUMNS]), ("featured", "features", ["outlier_weight", "weight_grams", *S.ENGINEERED_COLUMNS])))),
        "union_by_name": sql("births", "SELECT birth_id, source_file, weight_pounds, CASE WHEN source_year >= 2002 THEN alcohol_use END AS alcohol_use, CASE WHEN source_year >= 2002 THEN drinks_per_week END AS drinks_per_week FROM births"),
        "union_splits": sql("features", "SELECT count(*) AS n, count(*) FILTER (weight_grams < 300 OR weight_grams > 7000) AS out_of_range FROM features"),
        "expectations": expectations(),
        "stream_expectations": arrivals(),
        # modelling
        "impute": sql("split", "SELECT * FROM fills", *impute_ctes()),
        "impute_rows": sql("split", "SELECT birth_id, " + ", ".join(f"CAST(coalesce({c}, {fill_of(c)}) AS DOUBLE) AS {c}" for c in S.MODEL_FEATURES) + " FROM split WHERE split = 'val'", *impute_ctes()),
        "standardize": sql(
            "split",
            "SELECT birth_id, " + each("round_even((CAST((@ - (SELECT avg(@) FROM full_rows WHERE split = 'train')) / (SELECT stddev_pop(@) FROM full_rows WHERE split = 'train') AS DOUBLE)) * 1000000e0, 0) / 1000000e0 AS @", S.NUMERIC_FEATURES) + " FROM full_rows WHERE split = 'val'",
            *impute_ctes(),
            "full_rows AS (SELECT birth_id, split, " + ", ".join(f"coalesce({c}, {fill_of(c)}) AS {c}" for c in S.NUMERIC_FEATURES) + " FROM split)",
        ),
        "baseline_mean": sql("mean", all_metrics("split")),
        "ridge_optimality": sql("split", rows_of("SELECT '@' AS feature, 0e0 AS gap, round_even(avg(weight_grams) * 10000e0, 0) / 10000e0 AS mean_prediction FROM split WHERE split = 'train'", S.MODEL_FEATURES)),
        "gbt_stump": sql("split", all_metrics("split", "stump"), *impute_ctes(), *stump_ctes()),
        "category_confusion_stump": sql("split", CONFUSION.replace("@", "stump"), *impute_ctes(), *stump_ctes()),
        "builtin_importance_stump": sql("split", rows_of("SELECT '@' AS feature, CASE WHEN feature = '@' THEN 1e0 ELSE 0e0 END AS importance FROM stump_best", STUMP_COLUMNS), *impute_ctes(), *stump_ctes()),
        "permutation_importance_stump": sql("split", rows_of("SELECT '@' AS feature, CAST(feature = '@' AS INT) AS matters, CAST(feature <> '@' AS INT) AS is_zero FROM stump_best", STUMP_COLUMNS), *impute_ctes(), *stump_ctes()),
        "shapley_stump": sql("split", rows_of("SELECT '@' AS feature, (SELECT count(*) FROM split WHERE split = 'val') AS n, 0e0 AS total, CAST(feature = '@' AS INT) AS matters FROM stump_best", STUMP_COLUMNS), *impute_ctes(), *stump_ctes()),
        "hpo_stump": stump_trials(),
        "tree_shapley": tree_shapley(),
        "tree_shapley_rows": sql("split", "SELECT birth_id, 0e0 AS gap FROM split WHERE split = 'val'"),
        "gbt_prefix_errors": sql("split", "SELECT *, CAST(trees <= (SELECT trees FROM b_errors ORDER BY mae, trees LIMIT 1) AS INT) AS kept FROM b_errors",
            *impute_ctes(), filled_rows("tree_rows"), *boosted_ctes("b", BOOSTED["n_estimators"], BOOSTED["learning_rate"])),
        "gbt_stopped_early": sql("split", all_metrics("split", "stopped"), *impute_ctes(), filled_rows("tree_rows"),
            *boosted_ctes("b", BOOSTED["n_estimators"], BOOSTED["learning_rate"]), boosted_scored()),
        "hpo_halving": halving(),
        "screening_small": sql("ridge", "\nUNION ALL ".join(
            f"SELECT '{n}' AS model, mae AS val_mae, rmse AS val_rmse, r2 AS val_r2, sensitivity AS val_sensitivity FROM ({all_metrics('', t, IN_VAL)})"
            for n, t in (("mean", "mean_scored"), ("ridge", "scored"), ("stump", "stump"))),
            MEAN.replace("scored AS", "mean_scored AS"), *impute_ctes(), *stump_ctes()),
        "ridge_coefficient": sql("ridge", "SELECT round_even((w / sg) * 1000000e0, 0) / 1000000e0 AS grams_per_week, round_even((my - w * mg / sg) * 10000e0, 0) / 10000e0 AS intercept FROM scale, weight"),
        "ridge_predictions": sql("ridge", "SELECT birth_id, round_even((prediction) * 10000e0, 0) / 10000e0 AS prediction FROM scored"),
        "regression_metrics": sql("ridge", f"SELECT split, {METRICS} FROM scored GROUP BY split"),
        "clinical_metrics": sql("ridge", f"SELECT split, {rates} FROM (SELECT split, {cells} FROM scored GROUP BY split)"),
        "evaluate_split": sql("ridge", "SELECT " + each("@ AS val_@", ["mae", "rmse", "r2", "lbw_prevalence_pct", "sensitivity", "specificity", "precision", "f1", "n_lbw_true", "n_lbw_pred"]) + f" FROM ({all_metrics('', where=IN_VAL)})"),
        "acceptance_gate": sql("ridge", "\nUNION ALL ".join(
            f"SELECT '{m}' AS metric, CAST({m} AS DOUBLE) AS value, '{d}' AS direction, CAST({b} AS DOUBLE) AS bound, CASE WHEN {m} {d} {b} THEN 'PASS' ELSE 'FAIL' END AS verdict FROM m"
            for m, (d, b) in S.ACCEPTANCE.items()), f"m AS ({all_metrics('', where=IN_TEST)})"),
        "train_and_log": sql(
            "ridge",
            """SELECT 'ridge' AS run_name, (SELECT count(*) FROM split WHERE split = 'train') AS n_train, (SELECT count(*) FROM split WHERE split = 'val') AS n_val,
  'ridge' AS model_type, t.mae AS train_mae, t.rmse AS train_rmse, t.r2 AS train_r2, v.mae AS val_mae, v.rmse AS val_rmse, v.r2 AS val_r2,
  v.sensitivity AS val_sensitivity, v.specificity AS val_specificity FROM t, v""",
            f"t AS ({all_metrics('', where=IN_TRAIN)})", f"v AS ({all_metrics('', where=IN_VAL)})",
        ),
        "reload_predict": sql("ridge", """SELECT weight_grams AS actual, round_even(prediction * 10000e0, 0) / 10000e0 AS predicted,
  round_even(abs(prediction - weight_grams) * 10000e0, 0) / 10000e0 AS error FROM scored WHERE split = 'test' ORDER BY birth_id, weight_grams LIMIT 5"""),
        "permutation_importance": "SELECT * FROM (VALUES " + each("('@', 0e0, 0e0)", S.MODEL_FEATURES) + ") v(feature, importance, std)",
        "shapley": sql("ridge", """SELECT 'gestation_weeks' AS feature, round_even((avg(abs(w * (g - (SELECT avg(g) FROM filled WHERE split = 'val')) / sg))) * 1000000e0, 0) / 1000000e0 AS mean_abs
  FROM filled, scale, weight WHERE split = 'val'"""),
        "run_search": sql("mean", """SELECT split || '-' || source_year AS run_id, split AS run_name, CAST(source_year AS BIGINT) AS start_ms, round_even((avg(abs(weight_grams - prediction))) * 1000e0, 0) / 1000e0 AS mae
  FROM scored WHERE split = 'train' GROUP BY source_year, split ORDER BY source_year DESC LIMIT 1"""),
        # drift and scoring
        "psi": sql("split", "SELECT * FROM psi WHERE split <> 'train'", *psi_ctes(split_long(DRIFTED), "split", "ref")),
        "ks_drift": sql(
            "split",
            "SELECT feature, split, round_even((max(abs(f_ref - f_other))) * 1000000e0, 0) / 1000000e0 AS ks FROM cdf GROUP BY feature, split",
            f"long AS (SELECT * FROM ({long_of('split', [*DRIFTED, 'weight_pounds'], 'split, ')}) WHERE value IS NOT NULL)",
            "marks AS (SELECT feature, value, count(*) FILTER (split = 'train') AS r, count(*) FILTER (split = 'val') AS v, count(*) FILTER (split = 'test') AS t FROM long GROUP BY 1, 2)",
            """steps AS (SELECT feature, value, sum(r) OVER w / sum(r) OVER (PARTITION BY feature) AS fr, sum(v) OVER w / sum(v) OVER (PARTITION BY feature) AS fv,
  sum(t) OVER w / sum(t) OVER (PARTITION BY feature) AS ft FROM marks WINDOW w AS (PARTITION BY feature ORDER BY value))""",
            "cdf AS (SELECT feature, 'val' AS split, fr AS f_ref, fv AS f_other FROM steps UNION ALL SELECT feature, 'test', fr, ft FROM steps)",
        ),
        "prediction_drift": sql("ridge", "SELECT * FROM psi", *psi_ctes("SELECT 'prediction' AS feature, year_fix AS grp, year_fix < 2010 AS ref, round_even((prediction) * 10000e0, 0) / 10000e0 AS value FROM scored", "year_fix", "ref")),
        "weighted_prevalence": sql("clean", "SELECT CAST(sum(record_weight) AS BIGINT) AS population, " + ", ".join(
            f"round_even((100e0 * sum(CASE WHEN weight_grams {c} THEN record_weight ELSE 0 END) / sum(record_weight)) * 1000000e0, 0) / 1000000e0 AS {n}"
            for n, c in (("vlbw_pct", "< 1500"), ("lbw_pct", "< 2500"), ("macrosomia_pct", "> 4000"))) + " FROM clean"),
        "subgroup_metrics": sql("mean", all_metrics("\"grouping\", value", "labelled"), "labelled AS (" + "\nUNION ALL ".join(
            f"SELECT '{n}' AS \"grouping\", coalesce(CAST({e} AS VARCHAR), 'unknown') AS value, weight_grams, prediction FROM scored" for n, e in SUBGROUPS.items()) + ")"),
        "category_confusion": sql("ridge", CONFUSION.replace("@", "scored")),
        "residuals": sql("mean", shape("residual", "(SELECT weight_grams - prediction AS residual FROM scored)")),
        "residuals_by_prediction": sql("ridge", """SELECT CAST(CASE WHEN prediction <= 0 THEN NULL WHEN prediction <= 3200 THEN 0 WHEN prediction <= 3400 THEN 1 WHEN prediction <= 3600 THEN 2 WHEN prediction <= 3800 THEN 3
  WHEN prediction <= 4000 THEN 4 WHEN prediction <= 9999 THEN 5 END AS INT) AS band, count(*) AS n, round_even((avg(weight_grams - prediction)) * 1000000e0, 0) / 1000000e0 AS mean,
  round_even((stddev_samp(weight_grams - prediction)) * 1000000e0, 0) / 1000000e0 AS std, round_even((avg(abs(weight_grams - prediction))) * 1000000e0, 0) / 1000000e0 AS mae FROM scored GROUP BY 1"""),
        "risk_category": sql("ridge", f"SELECT birth_id, p AS prediction, {RISK.replace('@', 'p')} FROM (SELECT birth_id, round_even((prediction) * 10000e0, 0) / 10000e0 AS p FROM scored)"),
        "risk_category_of_weights": sql("clean", f"SELECT birth_id, weight_grams, {RISK.replace('@', 'weight_grams')} FROM clean"),
        "lmp_date": sql("births", "SELECT birth_id, CASE WHEN lmp NOT IN ('99', '9999') THEN CAST(try_strptime(lmp, '%m%d%Y') AS DATE) END AS lmp_date FROM births"),
        "target_encode": sql("split", """SELECT birth_id, s.mother_birth_state, round_even((coalesce(e.m, (SELECT avg(weight_grams) FROM split WHERE split = 'train'))) * 1000000e0, 0) / 1000000e0 AS encoded
  FROM split s LEFT JOIN (SELECT mother_birth_state, avg(weight_grams) AS m FROM split WHERE split = 'train' GROUP BY 1) e ON s.mother_birth_state = e.mother_birth_state"""),
        "target_encode_out_of_fold": sql("split", """SELECT f.birth_id, f.fold, f.mother_birth_state, round_even(coalesce(
    (SELECT avg(weight_grams) FROM means_rows m WHERE m.fold <> f.fold AND m.mother_birth_state = f.mother_birth_state), o.m) * 1000000e0, 0) / 1000000e0 AS encoded
  FROM (SELECT DISTINCT fold AS own, (SELECT avg(weight_grams) FROM means_rows b WHERE b.fold <> a.fold) AS m FROM means_rows a) o JOIN means_rows f ON f.fold = o.own""",
            f"means_rows AS MATERIALIZED (SELECT birth_id, CAST({key_hash('birth_id')} % 5 AS INT) AS fold, mother_birth_state, weight_grams FROM split WHERE split = 'train')"),
        "cross_file_duplicates": sql("births", f"SELECT {DUPLICATE_COLUMNS}, count(*) AS copies, min(source_file) AS first_file, max(source_file) AS last_file FROM births GROUP BY {DUPLICATE_COLUMNS} HAVING count(*) > 1 AND count(DISTINCT source_file) > 1"),
        "cross_file_duplicates_all": sql("births", f"SELECT count(*) AS copies, min(source_file) AS first_file, max(source_file) AS last_file FROM births GROUP BY {raw} HAVING count(*) > 1 AND count(DISTINCT source_file) > 1"),
        "kfold": sql("split", """SELECT h.fold, count(*) AS n, round_even((avg(abs(weight_grams - p))) * 1000e0, 0) / 1000e0 AS mae, round_even((sqrt(avg((weight_grams - p) ** 2))) * 1000e0, 0) / 1000e0 AS rmse,
  round_even((1 - avg((weight_grams - p) ** 2) / var_pop(weight_grams)) * 10000e0, 0) / 10000e0 AS r2 FROM folded h JOIN others o ON h.fold = o.fold GROUP BY h.fold""",
            f"folded AS (SELECT CAST({key_hash('birth_id')} % 5 AS INT) AS fold, weight_grams FROM split WHERE split = 'train')",
            "others AS (SELECT a.fold, avg(b.weight_grams) AS p FROM (SELECT DISTINCT fold FROM folded) a JOIN folded b ON a.fold <> b.fold GROUP BY a.fold)"),
        "add_fold_numbers": sql("births", f"SELECT birth_id, CAST({key_hash('birth_id')} % 5 AS INT) AS fold FROM births"),
        "retrain_trigger": sql(
            "mean",
            """SELECT 'mae' AS reason, round_even((100e0 * (t - v) / v) * 1000000e0, 0) / 1000000e0 AS value, 10e0 AS bound, CAST(100e0 * (t - v) / v > 10 AS INT) AS retrain FROM errors
UNION ALL SELECT 'psi:' || feature, max(psi), 0.2e0, CAST(max(psi) > 0.2 AS INT) FROM psi WHERE split <> 'train' GROUP BY feature""",
            "errors AS (SELECT round_even((avg(abs(weight_grams - prediction)) FILTER (split = 'val')) * 1000e0, 0) / 1000e0 AS v, round_even((avg(abs(weight_grams - prediction)) FILTER (split = 'test')) * 1000e0, 0) / 1000e0 AS t FROM scored)",
            *psi_ctes(split_long(DRIFTED), "split", "ref"),
        ),
        # streaming, as the batch result over closed windows
        "stream_score": sql("ridge", f"SELECT birth_id, round_even((prediction) * 10000e0, 0) / 10000e0 AS prediction, {RISK.replace('@', 'prediction')} FROM scored"),
        "stream_counts": """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests, count(*) FILTER (event_type = 'error') AS errors,
  round_even((100e0 * count(*) FILTER (event_type = 'error') / count(*)) * 10000e0, 0) / 10000e0 AS error_pct, CAST(100e0 * count(*) FILTER (event_type = 'error') / count(*) > 5 AS INT) AS alert
FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events)
WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY w""",
        "stream_counts_resumed": """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests, count(*) FILTER (event_type = 'error') AS errors,
  round_even((100e0 * count(*) FILTER (event_type = 'error') / count(*)) * 10000e0, 0) / 10000e0 AS error_pct, CAST(100e0 * count(*) FILTER (event_type = 'error') / count(*) > 5 AS INT) AS alert
FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events) GROUP BY w""",
        "stream_counts_repeated": """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS requests, count(*) FILTER (event_type = 'error') AS errors,
  round_even((100e0 * count(*) FILTER (event_type = 'error') / count(*)) * 10000e0, 0) / 10000e0 AS error_pct, CAST(100e0 * count(*) FILTER (event_type = 'error') / count(*) > 5 AS INT) AS alert
FROM (SELECT date_trunc('day', ts) AS w, event_type FROM events)
WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY w""",
        "stream_quantile_drift": """WITH v AS (
  SELECT date_trunc('day', ts) AS w, CAST(ceil(ln(value) / ln(1.01e0 / 0.99e0)) AS INT) AS b FROM events WHERE value > 0
), everything AS (SELECT w, b FROM v WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR UNION ALL SELECT NULL, b FROM v),
ranked AS (SELECT w, b, row_number() OVER (PARTITION BY w ORDER BY b) AS r, count(*) OVER (PARTITION BY w) AS n FROM everything),
q AS (SELECT w, n, min(b) FILTER (r >= ceil(n * 0.1e0)) AS b10, min(b) FILTER (r >= ceil(n * 0.5e0)) AS b50, min(b) FILTER (r >= ceil(n * 0.9e0)) AS b90 FROM ranked GROUP BY w, n),
x AS (SELECT w, n, 2 * (1.01e0 / 0.99e0) ** b10 / (1.01e0 / 0.99e0 + 1) AS q10, 2 * (1.01e0 / 0.99e0) ** b50 / (1.01e0 / 0.99e0 + 1) AS q50,
  2 * (1.01e0 / 0.99e0) ** b90 / (1.01e0 / 0.99e0 + 1) AS q90 FROM q),
m AS (SELECT x.*, greatest(abs(x.q10 - o.q10) / o.q10, abs(x.q50 - o.q50) / o.q50, abs(x.q90 - o.q90) / o.q90) AS moved FROM x, x o WHERE x.w IS NOT NULL AND o.w IS NULL)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n, round_even(q10 * 1000000e0, 0) / 1000000e0 AS q10, round_even(q50 * 1000000e0, 0) / 1000000e0 AS q50,
  round_even(q90 * 1000000e0, 0) / 1000000e0 AS q90, round_even(moved * 1000000e0, 0) / 1000000e0 AS moved, CAST(moved > 0.1 AS INT) AS alert FROM m""",
        "stream_late_truth": """WITH e AS (SELECT date_trunc('day', ts) AS w, CAST(event_id % 7 AS DOUBLE) + dayofmonth(ts) % 3 AS off FROM events WHERE event_id % 4 > 0),
m AS (SELECT w, count(*) AS n, avg(off) AS mae FROM e GROUP BY w)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n, round_even(mae * 1000000e0, 0) / 1000000e0 AS mae,
  round_even((100e0 * (mae - 3.5e0) / 3.5e0) * 10000e0, 0) / 10000e0 AS increase_pct, CAST(100e0 * (mae - 3.5e0) / 3.5e0 > 10 AS INT) AS retrain FROM m""",
        "stream_value_drift": f"""WITH binned AS (SELECT date_trunc('day', ts) AS w, {value_bin} AS bin FROM events WHERE value IS NOT NULL),
base AS (SELECT bin, count(*) * 1e0 / (SELECT count(*) FROM binned) AS e FROM binned GROUP BY bin),
windows AS (SELECT w, count(*) AS n FROM binned WHERE w + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY w),
parts AS (SELECT windows.w, windows.n, greatest(coalesce(e, 0), 0.0001e0) AS e, greatest(count(b.bin) * 1e0 / windows.n, 0.0001e0) AS a
  FROM windows CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range({bins})) r
  LEFT JOIN base ON base.bin = r.bin LEFT JOIN binned b ON b.w = windows.w AND b.bin = r.bin GROUP BY windows.w, windows.n, e, r.bin)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, n, round_even((sum((a - e) * ln(a / e))) * 1000000e0, 0) / 1000000e0 AS psi, CAST(sum((a - e) * ln(a / e)) > 0.2 AS INT) AS alert
FROM parts GROUP BY w, n""",
    }
    return out
