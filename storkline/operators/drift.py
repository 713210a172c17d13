"""Drift, subgroup and scoring reports, target encoding, duplicates and retraining rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storkline import schema as S
from storkline.functions.columns import flag, rint_to
from storkline.functions.counts import quantiles, running_totals, value_counts_long
from storkline.functions.joins import join_lookup
from storkline.functions.sampling import add_fold
from storkline.operators.clean import null_unknown_lmp
from storkline.operators.features import OPEN_WEIGHT_EDGES, cut
from storkline.operators.metrics import all_metrics

PSI_ALERT = 0.2
PSI_FLOOR = 1e-4


def psi(
    df: DataFrame, columns: list[str], group: str, is_reference: Column, bins: int = 10,
    alert: float = PSI_ALERT, digits: int = 6, others_only: bool = False,
) -> DataFrame:
    """Population stability index of each column in each group against the reference rows.

    One scan counts values; the bin edges are the reference quantiles; an empty bin counts as a
    share of 0.0001. ``others_only`` leaves out groups with reference rows, after the counts, so that all
    branches still share the scan.
    """
    marked = df.withColumn("_ref", F.coalesce(is_reference, F.lit(False)))
    counts = value_counts_long(marked, columns, [group, "_ref"])
    n_ref = F.when(F.col("_ref"), F.col("n")).otherwise(0)
    reference = counts.groupBy("feature", "value").agg(F.sum(n_ref).alias("n"))
    levels = {f"e{i}": i / bins for i in range(1, bins)}
    edges = quantiles(reference, ["feature"], levels).select(
        "feature", F.array_distinct(F.array(*levels)).alias("edges")
    )
    number = F.when(F.col("value").isNotNull(), F.size(F.filter("edges", lambda e: e < F.col("value"))))
    # one row of edges per column of the frame
    placed = counts.join(F.broadcast(edges), "feature").withColumn("_bin", number)
    in_bin = [F.col("_bin") == i for i in range(bins)]
    wide = placed.groupBy("feature", group).agg(
        *[F.sum(F.when(c, F.col("n")).otherwise(0)).alias(f"a{i}") for i, c in enumerate(in_bin)],
        *[F.sum(F.when(c, n_ref).otherwise(0)).alias(f"r{i}") for i, c in enumerate(in_bin)],
        F.max("_ref").alias("_has_ref"),
    )
    expected = wide.groupBy("feature").agg(*[F.sum(f"r{i}").alias(f"e{i}") for i in range(bins)])
    # again one row per column of the frame
    shown = wide.filter(~F.col("_has_ref")) if others_only else wide
    both = shown.join(F.broadcast(expected), "feature")

    def shares(prefix: str) -> list[Column]:
        cells = [F.col(f"{prefix}{i}") for i in range(bins)]
        total = F.nullif(sum(cells, F.lit(0)), F.lit(0))
        return [F.greatest(c / total, F.lit(PSI_FLOOR)) for c in cells]

    value = sum(((a - e) * F.ln(a / e) for a, e in zip(shares("a"), shares("e"))), F.lit(0.0))
    return both.select(
        "feature", group, rint_to(value, digits).alias("psi"), (value > alert).cast("int").alias("alert")
    )


def split_psi(df: DataFrame, columns: list[str]) -> DataFrame:
    """PSI of validation and test rows against training rows."""
    return psi(df, columns, "split", F.col("split") == "train", others_only=True)


def ks_drift(df: DataFrame, columns: list[str], reference: str = "train", others: list[str] = ("val", "test"), digits: int = 6) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic of each other split against the reference."""
    counts = value_counts_long(df, columns, ["split"]).filter(F.col("value").isNotNull())
    names = [reference, *others]
    per_value = counts.groupBy("feature", "value").agg(*[
        F.sum(F.when(F.col("split") == s, F.col("n")).otherwise(0)).alias(s) for s in names
    ])
    ranked = running_totals(per_value, ["feature"], "value", names)

    def cdf(s: str) -> Column:
        return F.col(f"{s}_upto") / F.nullif(F.col(f"{s}_total"), F.lit(0))

    wide = ranked.groupBy("feature").agg(*[F.max(F.abs(cdf(reference) - cdf(s))).alias(s) for s in others])
    return wide.unpivot(["feature"], list(others), "split", "ks").withColumn("ks", rint_to(F.col("ks"), digits))


def prediction_drift(scored: DataFrame, prediction: str = "prediction") -> DataFrame:
    """PSI of each year's predictions against those of the training years."""
    return psi(scored, [prediction], "year_fix", F.col("year_fix") < S.VAL_START)


def weighted_prevalence(df: DataFrame, column: str = S.TARGET, weight: str = "record_weight", digits: int = 6) -> DataFrame:
    """Clinical class shares in which a half-sampled record counts twice."""
    grams, w = F.col(column), F.col(weight)
    known = df.filter(grams.isNotNull() & w.isNotNull())
    shares = {
        "vlbw_pct": grams < S.VLBW_GRAMS,
        "lbw_pct": grams < S.LBW_GRAMS,
        "macrosomia_pct": grams > S.MACROSOMIA_GRAMS,
    }
    return known.agg(
        F.sum(w).cast("long").alias("population"),
        *[
            rint_to(100.0 * F.sum(F.when(c, w).otherwise(0)) / F.sum(w), digits).alias(name)
            for name, c in shares.items()
        ],
    )


def gestation_bracket(weeks: Column) -> Column:
    return (
        F.when(weeks < S.PRETERM_BELOW, "preterm")
        .when(weeks > S.POST_TERM_ABOVE, "post-term")
        .when(weeks.isNotNull(), "term")
    )


def subgroup_metrics(scored: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """All metrics per value of each grouping; every row counts once in each grouping."""
    labels = F.array(*[
        F.struct(F.lit(name).alias("grouping"), F.coalesce(column.cast("string"), F.lit("unknown")).alias("value"))
        for name, column in groups.items()
    ])
    labelled = scored.select(S.TARGET, "prediction", F.inline(labels))
    return all_metrics(labelled, ["grouping", "value"])


def three_classes(grams: Column) -> Column:
    return (
        F.when(grams < S.LBW_GRAMS, "LBW")
        .when(grams > S.MACROSOMIA_GRAMS, "Macrosomia")
        .when(grams.isNotNull(), "Normal")
    )


def category_confusion(scored: DataFrame, y: str = S.TARGET, p: str = "prediction") -> DataFrame:
    return scored.groupBy(
        three_classes(F.col(y)).alias("true_class"), three_classes(F.col(p)).alias("predicted_class")
    ).agg(F.count(F.lit(1)).alias("n"))


def residuals(scored: DataFrame, y: str = S.TARGET, p: str = "prediction") -> DataFrame:
    return scored.withColumn("residual", F.col(y) - F.col(p))


def residuals_by_prediction(scored: DataFrame, edges: list[float], digits: int = 6) -> DataFrame:
    """Mean, deviation and mean size of the residual per band of the prediction."""
    bands = cut(F.col("prediction"), edges, list(range(len(edges) - 1)))
    error = F.col("residual")
    return residuals(scored).groupBy(bands.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), rint_to(F.avg(error), digits).alias("mean"),
        rint_to(F.stddev(error), digits).alias("std"), rint_to(F.avg(F.abs(error)), digits).alias("mae"),
    )


def risk_category(scored: DataFrame, prediction: str = "prediction", margin: float = 100.0) -> DataFrame:
    """Label of the predicted weight and a flag for the band around the low-weight limit."""
    grams = F.col(prediction)
    near = grams.between(S.LBW_GRAMS - margin, S.LBW_GRAMS + margin)
    return scored.withColumns({
        "risk": cut(grams, list(OPEN_WEIGHT_EDGES), S.WEIGHT_CATEGORIES), "near_limit": flag(near),
    })


def lmp_date(df: DataFrame) -> DataFrame:
    """The last-menstrual-period text as a date; unknown or impossible dates are null."""
    return null_unknown_lmp(df).withColumn("lmp_date", F.try_to_date("lmp", "MMddyyyy"))


def fit_target_encoding(train: DataFrame, column: str, target: str = S.TARGET) -> DataFrame:
    """Mean target per category, from training rows only."""
    return train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.avg(target).alias(f"{column}_encoded"))


def target_encode(df: DataFrame, train: DataFrame, column: str, target: str = S.TARGET) -> DataFrame:
    """Adds the encoded category; an unseen or unknown one gets the overall training mean."""
    encoding = fit_target_encoding(train, column, target)
    overall = train.agg(F.avg(target)).scalar()
    joined = join_lookup(df, encoding, [column])
    return joined.withColumn(f"{column}_encoded", F.coalesce(f"{column}_encoded", overall))


def target_encode_out_of_fold(
    train: DataFrame, column: str, key: str, k: int = 5, target: str = S.TARGET, seed: int = 42
) -> DataFrame:
    """Adds ``fold`` and the encoded category of training rows; no row's own target takes part in its value.

    A row gets the mean target of its category over the other folds, or, where they do not have the category, theirs
    over all categories. Folds are by key, so copies of a record never encode each other. One aggregate by
    category and fold is all that is counted; means of the other folds are its totals less the fold's own.
    """
    folded = add_fold(train, k, key, seed)
    known = F.col(target).isNotNull()
    sums = folded.groupBy(column, "fold").agg(F.sum(target).alias("_s"), F.count(F.when(known, 1)).alias("_n"))

    def others(everything, s: str, n: str) -> Column:
        """Mean over the folds of ``everything`` but the row's own."""
        left = {c: F.sum(c).over(everything) - F.col(c) for c in (s, n)}
        return F.when(left[n] > 0, left[s] / left[n])

    # one row per fold
    overall = sums.groupBy("fold").agg(F.coalesce(F.sum("_s"), F.lit(0.0)).alias("_fs"), F.sum("_n").alias("_fn"))
    overall = overall.select("fold", others(Window.partitionBy(), "_fs", "_fn").alias("_overall"))
    by_category = sums.filter(F.col(column).isNotNull()).withColumn("_s", F.coalesce("_s", F.lit(0.0)))
    by_category = by_category.select(column, "fold", others(Window.partitionBy(column), "_s", "_n").alias("_others"))
    joined = join_lookup(folded, by_category, [column, "fold"]).join(F.broadcast(overall), "fold", "left")
    return joined.select(*folded.columns, F.coalesce("_others", "_overall").alias(f"{column}_encoded"))


def cross_file_duplicates(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Records with equal values in ``columns`` that occur in more than one file.

    Copies collapse in the map-side aggregate, so a large group of copies costs one row per task.
    """
    columns = columns or [c for c in S.RAW_COLUMNS if c in df.columns]
    return (
        df.groupBy(*columns)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min("source_file").alias("first_file"),
            F.max("source_file").alias("last_file"),
        )
        .filter((F.col("copies") > 1) & (F.col("first_file") < F.col("last_file")))
    )


def retrain_trigger(
    baseline: DataFrame, current: DataFrame, drift: DataFrame, max_increase_pct: float = 10.0,
    max_psi: float = PSI_ALERT,
) -> DataFrame:
    """One row per reason to retrain: error worse than the baseline's, or a drifting column.

    ``baseline`` and ``current`` are one-row metrics, ``drift`` the result of ``psi``.
    """
    before, after = baseline.select("mae").scalar(), current.select("mae")
    increase = 100.0 * (F.col("mae") - before) / before
    by_error = after.select(
        F.lit("mae").alias("reason"), rint_to(increase, 6).alias("value"),
        F.lit(float(max_increase_pct)).alias("bound"), flag(increase > max_increase_pct).cast("int").alias("retrain"),
    )
    by_drift = drift.groupBy("feature").agg(F.max("psi").alias("value")).select(
        F.concat(F.lit("psi:"), "feature").alias("reason"), "value", F.lit(float(max_psi)).alias("bound"),
        flag(F.col("value") > max_psi).cast("int").alias("retrain"),
    )
    return by_error.unionByName(by_drift)
