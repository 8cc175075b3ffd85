"""Data-quality profiling: counts, null/NaN/Inf profiles, label balance,
describe-style statistics, domain checks, median fill.

Every profile is ONE aggregate pass over the data (the notebooks this
replaces ran one job per column); results are small long-form tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.columns import is_invalid, nan_to_null, pct_half_up
from event_ml.functions.joins import materialise
from event_ml.functions.quantiles import exact_quantiles


def _long(row_df: DataFrame, cols: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn one wide stats row (``{col}__{stat}``) into one row per column."""
    items = [
        F.struct(
            F.lit(c).alias("feature"),
            *[F.col(f"{c}__{stat}").alias(stat) for stat in fields],
        )
        for c in cols
    ]
    out = row_df.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    return out.select("feature", *[F.col(s).cast(t).alias(s) for s, t in fields.items()])


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``."""
    return df.orderBy(*order).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def missing_flags(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, feature, missing) with missing = 1 if the value is null else 0."""
    return df.select(
        key,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).isNull().cast("int").alias("missing"))
                    for c in cols
                ]
            )
        ).alias("m"),
    ).select(key, "m.feature", "m.missing")


def null_profile(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Per column: nulls, null-or-NaN, pct of rows (half-even rounding), only
    columns with at least one null/NaN, plus the number of such columns."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        x = F.col(c)
        aggs.append(F.count_if(x.isNull()).alias(f"{c}__null_count"))
        aggs.append(F.count_if(x.isNull() | F.isnan(x)).alias(f"{c}__null_or_nan_count"))
    wide = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}__null_count").cast("long").alias("null_count"),
            F.col(f"{c}__null_or_nan_count").cast("long").alias("null_or_nan_count"),
            F.col("_n").alias("n"),
        )
        for c in cols
    ]
    long = wide.select(F.explode(F.array(*items)).alias("s")).select("s.*")
    long = long.filter(F.col("null_or_nan_count") > 0)
    return long.select(
        "feature",
        "null_count",
        "null_or_nan_count",
        F.bround(F.col("null_or_nan_count") / F.col("n") * 100, digits).alias("null_pct"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n_affected_columns"),
    )


def invalid_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a null, a NaN or an infinity in any of ``cols``."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | is_invalid(c)
    return df.filter(cond)


def invalid_summary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: total rows and rows with any null / NaN / +-Inf / any of them."""
    any_null = F.lit(False)
    any_nan = F.lit(False)
    any_inf = F.lit(False)
    for c in cols:
        x = F.col(c)
        any_null = any_null | x.isNull()
        any_nan = any_nan | F.coalesce(F.isnan(x), F.lit(False))
        any_inf = any_inf | F.coalesce(F.abs(x) == F.lit(float("inf")), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(any_null).cast("long").alias("n_null_rows"),
        F.count_if(any_nan).cast("long").alias("n_nan_rows"),
        F.count_if(any_inf).cast("long").alias("n_inf_rows"),
        F.count_if(any_null | any_nan | any_inf).cast("long").alias("n_invalid_rows"),
    )


def label_distribution(df: DataFrame, label_col: str = "label", digits: int = 2) -> DataFrame:
    """(label, count, pct) with pct = count / total * 100 rounded half-up."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    pct = pct_half_up(F.col("count"), total, digits)
    return counts.select(F.col(label_col).alias("label"), "count", pct.alias("pct")).orderBy("label")


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Typed describe(): count, mean, sample stddev, min, max per column."""
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__stddev"),
            F.min(c).alias(f"{c}__min"),
            F.max(c).alias(f"{c}__max"),
        ]
    long = _long(
        df.agg(*aggs),
        cols,
        {"count": "long", "mean": "double", "stddev": "double", "min": "double", "max": "double"},
    )
    if digits is None:
        return long
    return long.select(
        "feature",
        "count",
        F.round("mean", digits).alias("mean"),
        F.round("stddev", digits).alias("stddev"),
        "min",
        "max",
    )


def describe_quartiles(df: DataFrame, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """pandas-style describe: count, mean, std, min, 25%, 50%, 75%, max with
    exact linearly interpolated quartiles, rounded half-even."""
    clean = df.select(*[nan_to_null(c).alias(c) for c in cols])
    base = describe_numeric(clean, cols, digits=None)
    q = exact_quantiles(clean, cols, [0.25, 0.5, 0.75])
    qw = q.groupBy("feature").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in
          ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    joined = base.join(F.broadcast(qw), "feature")
    return joined.select(
        "feature",
        "count",
        *[F.bround(c, digits).alias(c) for c in ("mean", "stddev", "min", "q25", "q50", "q75", "max")],
    )


def column_medians(df: DataFrame, cols: Sequence[str], exact: bool = True, rel_error: float = 0.001) -> DataFrame:
    """(feature, median) ignoring null and NaN; exact (interpolated) or the
    approximate sketch with the given relative error."""
    if exact:
        return exact_quantiles(df, cols, [0.5]).select("feature", F.col("value").alias("median"))
    accuracy = max(1, int(round(1.0 / rel_error)))
    row = df.agg(
        *[
            F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), 0.5, accuracy).alias(c)
            for c in cols
        ]
    )
    items = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("median")) for c in cols]
    return row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def fill_from_map(df: DataFrame, fill: dict[str, float]) -> DataFrame:
    """Replace null AND NaN in each column by its value (fillna semantics)."""
    return df.fillna(fill)


def median_fill(df: DataFrame, cols: Sequence[str], exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """(filled table, medians).  Null and NaN are replaced by the column
    median.  The medians (one row, one value per column) are attached with a
    broadcast cross join, so nothing goes through the driver and the fill
    stays one lazy plan."""
    medians = materialise(column_medians(df, cols, exact=exact), "medians")
    wide = medians.agg(
        *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_med_{c}") for c in cols]
    )
    joined = df.crossJoin(F.broadcast(wide))
    filled = joined.select(
        *[
            F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.col(f"_med_{c}")).alias(c)
            if c in cols
            else F.col(c)
            for c in df.columns
        ]
    )
    return filled, medians


def distinct_values(df: DataFrame, col: str, domain: Sequence[float]) -> DataFrame:
    """(value, n, in_domain) for every distinct value of ``col``."""
    return df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n")).select(
        "value", "n", F.col("value").isin(*domain).alias("in_domain")
    )


def all_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, n_non_null, all_null) in one pass."""
    long = _long(df.agg(*[F.count(c).alias(f"{c}__n_non_null") for c in cols]), cols, {"n_non_null": "long"})
    return long.select("feature", "n_non_null", (F.col("n_non_null") == 0).alias("all_null"))
