"""Profiling reports: summaries, distributions, missingness, correlations and trends.

Reports on many columns read the data once. Exact quantiles, densities and box statistics work on
counted values (``functions.counts``), so no group is gathered in one task.
"""

from __future__ import annotations

import math

from numpy.polynomial.hermite_e import herme2poly
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import label_of, null_percent, percent, rint_to, whole_quotient
from storkline.functions.correlation import pair_correlations, pair_lines
from storkline.functions.counts import (
    QUARTILES, describe, moments, quantiles, running_totals, value_counts_long, value_counts_of,
)
from storkline.functions.normal import normal_quantile
from storkline.operators.features import OPEN_WEIGHT_EDGES, weight_category


def _as_double(column: str) -> Column:
    return F.col(column).cast("double")


# ---- sizes and files


def data_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, files, year range and ``missing_<column>`` in %."""
    aggregates = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols")]
    if "source_file" in df.columns:
        # one text per raw file
        aggregates.append(F.array_join(F.array_sort(F.collect_set("source_file")), ",").alias("files_included"))
    if "year_fix" in df.columns:
        aggregates += [F.min("year_fix").alias("year_min"), F.max("year_fix").alias("year_max")]
    aggregates += [
        null_percent(c, 2).alias(f"missing_{c}") for c in df.columns
    ]
    return df.agg(*aggregates)


def file_year_ranges(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("year_fix").alias("year_min"),
        F.max("year_fix").alias("year_max"),
        F.countDistinct("year_fix").alias("n_years"),
    )


def file_row_share(df: DataFrame, expected_files: int | None = None) -> DataFrame:
    """Rows per file and % of all; fails at run time when the number of files is unexpected."""
    per_file = df.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))
    # windows over one row per file
    total = F.sum("row_count").over(Window.partitionBy())
    share = rint_to(F.col("row_count") / total * 100.0, 1)
    if expected_files is not None:
        files = F.count(F.lit(1)).over(Window.partitionBy())
        error = F.raise_error(F.concat(F.lit(f"expected {expected_files} files, found "), files.cast("string")))
        share = F.when(files == expected_files, share).otherwise(error.cast("double"))
    return per_file.withColumn("pct", share)


# ---- numeric columns


def describe_numeric(df: DataFrame, columns: list[str], digits: int = 3) -> DataFrame:
    """Count, mean, deviation, range and exact quartiles of each column."""
    stats = describe(value_counts_long(df, columns), ["feature"])
    shown = ["mean", "std", "min", "q1", "median", "q3", "max"]
    return stats.select("feature", "n", *[rint_to(F.col(c), digits).alias(c) for c in shown])


def bias_corrected(n: Column, skew: Column, kurtosis: Column) -> tuple[Column, Column]:
    """Sample skewness and excess kurtosis from the population ones."""
    n = n.cast("double")
    skew = F.when(n > 2, skew * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))
    kurtosis = F.when(
        n > 3, (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0)) * ((n + 1) * kurtosis + 6)
    )
    return skew, kurtosis


def target_stats(df: DataFrame, column: str = S.TARGET, digits: int = 6) -> DataFrame:
    """One row: size, centre, spread, exact quartiles and bias-corrected shape of a column."""
    value = _as_double(column)
    counted = value_counts_of(df, column)
    levels = quantiles(counted, [], QUARTILES).select(F.array("median", "q1", "q3")).scalar()
    sums = df.agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        F.skewness(value).alias("g1"), F.kurtosis(value).alias("g2"),
    )
    skew, kurtosis = bias_corrected(F.col("n"), F.col("g1"), F.col("g2"))
    shown = {
        "mean": F.col("mean"), "median": levels[0], "std": F.col("std"), "min": F.col("min"),
        "max": F.col("max"), "q1": levels[1], "q3": levels[2], "skew": skew, "kurtosis": kurtosis,
    }
    return sums.select("n", *[rint_to(c, digits).alias(name) for name, c in shown.items()])


def category_prevalence(df: DataFrame, column: str = S.TARGET) -> DataFrame:
    """% of each clinical class; VLBW is part of LBW, and normal includes both its bounds."""
    grams = F.col(column)
    known = df.filter(grams.isNotNull())
    shares = {
        "vlbw_pct": grams < S.VLBW_GRAMS,
        "lbw_pct": grams < S.LBW_GRAMS,
        "normal_pct": grams.between(S.LBW_GRAMS, S.MACROSOMIA_GRAMS),
        "macrosomia_pct": grams > S.MACROSOMIA_GRAMS,
    }
    return known.agg(*[rint_to(percent(c), 2).alias(name) for name, c in shares.items()])


def category_counts(df: DataFrame, column: str = S.TARGET) -> DataFrame:
    """Rows and % of all known weights per category in clinical order, zeros kept."""
    category = weight_category(F.col(column), OPEN_WEIGHT_EDGES)
    wide = df.agg(
        F.count(column).alias("total"),
        *[F.count(F.when(category == name, 1)).alias(name) for name in S.WEIGHT_CATEGORIES],
    )
    total = F.greatest(F.col("total"), F.lit(1))
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("category"), F.col(name).alias("n"),
            rint_to(F.col(name) / total * 100.0, 1).alias("pct"),
        )
        for i, name in enumerate(S.WEIGHT_CATEGORIES)
    ])))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequency of every value including null, per column in order of value."""
    return value_counts_long(df, columns).orderBy("feature", F.col("value").asc_nulls_last())


def lbw_rate(df: DataFrame, column: str = S.TARGET, threshold: float = S.LBW_GRAMS) -> DataFrame:
    return df.agg(rint_to(percent(F.col(column) < threshold), 2).alias("lbw_pct"))


# ---- missing values


def missing_pct(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns with nulls, most missing first."""
    columns = columns or df.columns
    wide = df.agg(*[F.struct(
        F.lit(c).alias("feature"),
        F.count(F.when(F.col(c).isNull(), 1)).alias("missing_count"),
        null_percent(c, 2).alias("missing_pct"),
    ).alias(c) for c in columns])
    long = wide.select(F.inline(F.array(*columns)))
    return long.filter("missing_count > 0").orderBy(F.desc("missing_count"), "feature")


def missing_by_file(df: DataFrame, columns: list[str] = S.KEY_MISSING_COLUMNS) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.groupBy("source_file").agg(*[
        null_percent(c, 1).alias(c) for c in present
    ])


def missing_patterns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """How often each combination of nulls occurs: one character per column, 1 for null."""
    columns = columns or df.columns
    mask = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return df.groupBy(mask.alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


def completeness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Known values and share per column."""
    columns = columns or df.columns
    wide = df.agg(*[F.struct(
        F.lit(c).alias("feature"), F.count(c).alias("known"),
        rint_to(F.avg(F.col(c).isNotNull().cast("double")) * 100.0, 2).alias("known_pct"),
    ).alias(c) for c in columns])
    return wide.select(F.inline(F.array(*columns)))


def schema_profile(df: DataFrame, columns: list[str] | None = None, sample: bool = False) -> DataFrame:
    """Type, % null and, on request, one value of each column as text."""
    columns = columns or df.columns
    types = dict(df.dtypes)
    wide = df.agg(*[F.struct(
        F.lit(c).alias("feature"), F.lit(types[c]).alias("dtype"),
        null_percent(c, 1).alias("null_pct"),
        *([F.first(c).cast("string").alias("sample_value")] if sample else []),
    ).alias(c) for c in columns])
    return wide.select(F.inline(F.array(*columns)))


# ---- correlations


def corr_matrix(df: DataFrame, columns: list[str] = S.CORRELATION_COLUMNS, digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair in one pass; a pair with a null on either side is left out."""
    r = pair_correlations(df, columns)
    return r.filter("i < j").select(
        label_of(columns, F.col("i")).alias("a"), label_of(columns, F.col("j")).alias("b"), rint_to(F.col("r"), digits).alias("r"),
    )


def corr_with(df: DataFrame, columns: list[str], target: str = S.TARGET) -> DataFrame:
    r = pair_correlations(df, [*columns, target])
    last = len(columns)
    return r.filter((F.col("j") == last) & (F.col("i") < last)).select(label_of(columns, F.col("i")).alias("feature"), "r")


def corr_ranked(
    df: DataFrame, columns: list[str], target: str = S.TARGET, sign: int = 0, k: int | None = None,
    digits: int = 6,
) -> DataFrame:
    """Correlation with the target by absolute value; ``sign`` keeps positive or negative ones."""
    ranked = corr_with(df, columns, target).filter(F.col("r").isNotNull())
    if sign:
        ranked = ranked.filter(F.signum("r") == sign)
    ranked = ranked.orderBy(F.abs("r").desc(), "feature")
    if k is not None:
        ranked = ranked.limit(k)
    return ranked.withColumn("r", rint_to(F.col("r"), digits))


def leakage_corr(df: DataFrame, digits: int = 6) -> DataFrame:
    """Correlation of the post-birth scores with the weight on raw rows."""
    grams = df.withColumn("_grams", F.col("weight_pounds") * S.GRAMS_PER_POUND)
    present = [c for c in S.APGAR_COLUMNS if c in df.columns]
    return corr_with(grams, present, "_grams").withColumn("r", rint_to(F.col("r"), digits))


def point_biserial(df: DataFrame, flags: list[str], target: str = S.TARGET, digits: int = 6) -> DataFrame:
    """Correlation of 0/1 flags with the target and the mean target on both sides."""
    y = _as_double(target)
    wide = df.agg(*[F.struct(
        F.lit(c).alias("feature"), rint_to(F.corr(_as_double(c), y), digits).alias("r"),
        rint_to(F.avg(F.when(F.col(c) == 0, y)), digits).alias("mean_0"),
        rint_to(F.avg(F.when(F.col(c) == 1, y)), digits).alias("mean_1"),
    ).alias(c) for c in flags])
    return wide.select(F.inline(F.array(*flags)))


def trend_line(df: DataFrame, columns: list[str], target: str = S.TARGET, digits: int = 6) -> DataFrame:
    """Least-squares line of the target on each column over rows where both are known.

    From the same matrix products as the correlations; no row is multiplied by its pairs.
    """
    return pair_lines(df, columns, target).select(
        label_of(columns, F.col("i")).alias("feature"),
        rint_to(F.col("slope"), digits).alias("slope"), rint_to(F.col("intercept"), digits).alias("intercept"), "n",
    )


# ---- distributions


def yearly_trend(df: DataFrame, target: str = S.TARGET, digits: int = 6) -> DataFrame:
    """Per year: rows, mean, exact median, deviation, LBW and preterm rates, from one scan."""
    known = df.filter(F.col(target).isNotNull() & F.col("year_fix").isNotNull())
    # the flag is a key, so that every use of the counts has the same first aggregate and shares the scan
    flagged = known.groupBy("year_fix", _as_double(target).alias("value"), F.col("gestation_preterm").alias("flag"))
    n, flag = F.col("n"), F.col("flag")
    counts = flagged.agg(F.count(F.lit(1)).alias("n")).groupBy("year_fix", "value").agg(
        F.sum("n").alias("n"), F.sum(n * F.coalesce(flag, F.lit(0))).alias("n_preterm"),
        F.sum(F.when(flag.isNotNull(), n).otherwise(0)).alias("n_flagged"),
    )
    found = describe(counts, ["year_fix"], [
        (F.sum(F.when(F.col("value") < S.LBW_GRAMS, n).otherwise(0)) * 100.0 / F.sum("n")).alias("lbw_pct"),
        (F.sum("n_preterm") * 100.0 / F.nullif(F.sum("n_flagged"), F.lit(0))).alias("preterm_pct"),
    ])
    shown = ["mean", "median", "std", "lbw_pct", "preterm_pct"]
    return found.select("year_fix", "n", *[rint_to(F.col(c), digits).alias(c) for c in shown])


def histogram(df: DataFrame, columns: list[str], bins: int = 80, digits: int = 9) -> DataFrame:
    """Equal-width bins per column with counts and density; empty bins kept, last bin closed."""
    counts = value_counts_long(df, columns)
    ranges = counts.groupBy("feature").agg(
        F.min("value").alias("low"), F.max("value").alias("high"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n"))).alias("total"),
    )
    flat = F.col("low") == F.col("high")  # a constant column gets a range of width one
    ranges = ranges.select(
        "feature", "total",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        (F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")) / bins).alias("width"),
    )
    low, width, value = F.col("low"), F.col("width"), F.col("value")
    guess = F.when(value.isNotNull(), F.least(F.floor((value - low) / width), F.lit(bins - 1))).cast("int")
    # the quotient can land next to an edge; the edge itself decides
    exact = (
        F.when(value < low + guess * width, guess - 1)
        .when((value >= low + (guess + 1) * width) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    # one row per column of the frame; the total comes along so that both uses of the ranges share a scan
    placed = counts.join(F.broadcast(ranges), "feature")
    filled = placed.groupBy("feature", "total", exact.alias("bin")).agg(F.sum("n").alias("n"))
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(filled, ["feature", "total", "bin"], "left")
    n = F.coalesce("n", F.lit(0).cast("long"))
    return out.select(
        "feature", "bin",
        rint_to(low + F.col("bin") * width, digits).alias("bin_low"),
        rint_to(low + (F.col("bin") + 1) * width, digits).alias("bin_high"),
        n.alias("n"),
        rint_to(n / (F.col("total") * width), digits).alias("density"),
    )


# bandwidths beyond which a Gaussian kernel cannot be seen in a double
REACH = 9.0
# width of a cell in bandwidths, and moments kept of its values; see ``kde`` for the error
CELL, MOMENTS = 0.1, 8


def kde(
    df: DataFrame, column: str = S.TARGET, key: str | None = None, points: int = 1000,
    min_rows: int = 100, digits: int = 9,
) -> DataFrame:
    """Gaussian density on an even grid per group, Scott bandwidth; small groups are left out.

    The grid reaches half a range beyond the data on both sides. Rows are counted by value; values are binned
    in cells of ``CELL`` bandwidths, each with ``MOMENTS`` moments around its middle, and the cells are
    convolved with the kernel: the kernel of a value at distance u bandwidths from the middle is the sum
    over k of u^k / k! times the k-th Hermite polynomial times the kernel of the middle. What the moments
    leave out is below 1.09 (CELL / 2)^MOMENTS / sqrt(MOMENTS!), here 2e-13, of a kernel's peak. A cell is laid
    over the grid points within ``REACH`` bandwidths: beyond, a kernel is below 1e-17 of its peak. So beyond
    counting the work grows with the number of cells, about the fifth root of the rows, not with the values.
    """
    keys = [key] if key else []
    counts = value_counts_of(df, column, keys)
    stats = moments(counts, keys).filter((F.col("n") > min_rows) & (F.col("std") > 0))
    reach = F.col("max") - F.col("min")
    stats = stats.select(
        *keys, F.col("n").alias("total"),
        (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bandwidth"), F.col("min").alias("low"),
        (F.col("min") - 0.5 * reach).alias("start"), (2.0 * reach / (points - 1)).alias("step"),
    )
    if key:
        placed = counts.join(stats, key)
    else:
        placed = counts.withColumn("_stats", stats.select(F.struct("*")).scalar()).select("value", "n", "_stats.*")
        placed = placed.filter(F.col("total").isNotNull())
    size, middle = CELL * F.col("bandwidth"), F.col("low") + (F.col("cell") + 0.5) * CELL * F.col("bandwidth")
    placed = placed.withColumn("cell", F.floor((F.col("value") - F.col("low")) / size))
    off = (F.col("value") - middle) / F.col("bandwidth")
    cells = placed.groupBy(*keys, *[c for c in stats.columns if c not in keys], "cell").agg(
        *[F.sum(F.col("n") * F.pow(off, F.lit(k)) / math.factorial(k)).alias(f"m{k}") for k in range(MOMENTS)]
    )
    # each cell meets the grid points in reach inside its task and is summed there
    first = F.greatest(F.ceil((middle - REACH * F.col("bandwidth") - F.col("start")) / F.col("step")), F.lit(0))
    last = F.least(F.floor((middle + REACH * F.col("bandwidth") - F.col("start")) / F.col("step")), F.lit(points - 1))
    near = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))
    hermite = [herme2poly([0.0] * k + [1.0]) for k in range(MOMENTS)]
    powers = [sum(F.col(f"m{k}") * float(h[j]) for k, h in enumerate(hermite) if j < len(h) and h[j]) for j in range(MOMENTS)]
    spread = cells.select(
        *keys, *[c for c in stats.columns if c not in keys], middle.alias("middle"),
        *[c.alias(f"p{j}") for j, c in enumerate(powers)], F.explode(near).alias("point"),
    )
    x = F.col("start") + F.col("point") * F.col("step")
    z = (x - F.col("middle")) / F.col("bandwidth")
    series = F.lit(0.0)
    for j in reversed(range(MOMENTS)):
        series = series * z + F.col(f"p{j}")
    scale = F.col("total") * F.col("bandwidth") * 2.5066282746310002  # sqrt(2 pi)
    weights = spread.select(*keys, "point", x.alias("x"), scale.alias("scale"), (series * F.exp(-0.5 * z * z)).alias("weight"))
    # points that no value reaches stay, with density 0
    grid = stats.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    grid = grid.select(*keys, "point", x.alias("x"), scale.alias("scale"), F.lit(0.0).alias("weight"))
    out = weights.unionByName(grid).groupBy(*keys, "point", "x", "scale").agg(F.sum("weight").alias("weight"))
    return out.select(
        *keys, "point", rint_to(F.col("x"), 6).alias("x"),
        rint_to(F.greatest(F.lit(0.0), F.col("weight")) / F.col("scale"), digits).alias("density"),
    )


def box_stats(df: DataFrame, columns: list[str], key: str, digits: int = 6) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers at 1.5 IQR, notch and outlier count."""
    keys = [key, "feature"]
    counts = value_counts_long(df, columns, [key]).filter(F.col("value").isNotNull())
    box = quantiles(counts, keys, QUARTILES)
    spread = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - 1.5 * spread, F.col("q3") + 1.5 * spread)
    stats = counts.join(box, keys).groupBy(*keys, "q1", "median", "q3").agg(
        F.sum("n").alias("n"),
        F.min(F.when(inside, F.col("value"))).alias("low_in"),
        F.max(F.when(inside, F.col("value"))).alias("high_in"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers"),
    )
    notch = 1.57 * spread / F.sqrt("n")
    # interpolated quartiles can lie beyond every point inside; the whisker then has no length
    shown = {
        "q1": F.col("q1"), "median": F.col("median"), "q3": F.col("q3"),
        "whisker_low": F.least("low_in", "q1"), "whisker_high": F.greatest("high_in", "q3"),
        "notch_low": F.col("median") - notch, "notch_high": F.col("median") + notch,
    }
    return stats.select(*keys, "n", "outliers", *[rint_to(c, digits).alias(name) for name, c in shown.items()])


def qq_points(df: DataFrame, column: str = S.TARGET, n: int = 5000) -> DataFrame:
    """Normal Q-Q points of all rows: theoretical and ordered values at up to ``n`` ranks.

    The ranks are spread evenly from the smallest to the largest value, so the points are those of the plot
    of every row, shown at ``n`` places; with fewer rows than ``n`` each row is a point. Ranks come from
    counted values. ``i`` numbers the points.
    """
    ranked = running_totals(value_counts_of(df, column), [], "value", ["n"])
    total = F.col("n_total")
    points = F.least(total, F.lit(n).cast("long"))

    def first_point(rank: Column) -> Column:
        """The first point whose 0-based rank is not below ``rank``."""
        gaps = F.greatest(total - 1, F.lit(1))
        return whole_quotient(rank * (points - 1) + gaps - 1, gaps)

    low = first_point(F.col("n_upto") - F.col("n"))
    high = F.when(F.col("n_upto") == total, points).otherwise(first_point(F.col("n_upto")))
    held = ranked.select("value", total.alias("total"), points.alias("points"), low.alias("low"), high.alias("high"))
    shown = held.filter("low < high").select("*", F.explode(F.sequence(F.col("low"), F.col("high") - 1)).alias("at"))
    size = F.col("total").cast("double")
    rank = whole_quotient(F.col("at") * (F.col("total") - 1), F.greatest(F.col("points") - 1, F.lit(1))) + 1
    last = F.pow(F.lit(0.5), 1.0 / size)
    level = F.when(rank == F.col("total"), last).when(rank == 1, 1.0 - last).otherwise((rank - 0.3175) / (size + 0.365))
    return shown.select((F.col("at") + 1).cast("int").alias("i"), normal_quantile(level).alias("theoretical"), F.col("value").alias("ordered"))


def qq_line(points: DataFrame, digits: int = 6) -> DataFrame:
    """Line fitted through Q-Q points, and their correlation."""
    return points.agg(
        rint_to(F.regr_slope("ordered", "theoretical"), digits).alias("slope"),
        rint_to(F.regr_intercept("ordered", "theoretical"), digits).alias("intercept"),
        rint_to(F.corr("ordered", "theoretical"), digits).alias("r"),
    )


# ---- ordering results


def sort_metric(results: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    return results.orderBy(F.col(metric).asc() if ascending else F.col(metric).desc())


def top_k(results: DataFrame, k: int, metric: str, ascending: bool = False) -> DataFrame:
    return sort_metric(results, metric, ascending).limit(k)


def argmin_model(results: DataFrame, metric: str = "val_mae", model: str = "model") -> DataFrame:
    """Name and metric of the best model."""
    return results.agg(F.min_by(model, metric).alias("model"), F.min(metric).alias(metric))


