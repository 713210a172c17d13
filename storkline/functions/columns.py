"""Column expressions with the null and rounding rules used throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"


def strip(column: Column | str) -> Column:
    """Text without leading and trailing whitespace of any kind."""
    return F.trim(column, F.lit(WHITESPACE))


def rint_to(column: Column, digits: int) -> Column:
    """Round half to even at ``digits`` decimals (``round`` would round half up)."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def flag(condition: Column) -> Column:
    """0/1 byte; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("byte")


def clip(column: Column, low: float, high: float) -> Column:
    """Limit to [low, high] and keep nulls (``greatest`` and ``least`` skip them)."""
    return F.when(column.isNotNull(), F.greatest(F.lit(low), F.least(column, F.lit(high))))


def percent(condition: Column) -> Column:
    """Aggregate: % of rows on which the condition holds; unknown counts as no."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double")) * 100.0


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient that is 0 on an empty denominator."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def whole_quotient(numerator: Column, denominator: Column) -> Column:
    """Integer quotient, rounded towards zero, without passing through a floating-point number."""
    return F.call_function("div", numerator, denominator)


def null_percent(column: str, digits: int) -> Column:
    """Aggregate: % of rows on which a column is null."""
    return rint_to(F.avg(F.col(column).isNull().cast("double")) * 100.0, digits)


def rounded(columns: list[str], digits: int = 6) -> dict[str, Column]:
    """``withColumns`` argument that rounds result columns for a report."""
    return {c: rint_to(F.col(c), digits) for c in columns}


def paired_columns(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``(pair, x, y)``: each row once per pair of columns, to aggregate by pair.

    One small grouped aggregate compiles and runs faster than hundreds of aggregate columns.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    values = F.array(*[F.col(c).cast("double") for c in names])
    x, y = (F.array(*[F.lit(names.index(pair[side])) for pair in pairs]) for side in (0, 1))
    numbered = df.select(values.alias("_values"), F.explode(F.sequence(F.lit(0), F.lit(len(pairs) - 1))).alias("pair"))
    return numbered.select(
        "pair", F.get("_values", F.get(x, F.col("pair"))).alias("x"), F.get("_values", F.get(y, F.col("pair"))).alias("y")
    )


def label_of(names: list[str], position: Column) -> Column:
    """The name at a position."""
    return F.get(F.array(*[F.lit(n) for n in names]), position)
