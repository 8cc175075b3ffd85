"""Exploratory statistics: correlation pairs, per-class density histograms,
class separation, group values attached to rows (BI level-of-detail
expressions), group sums, unpivots, metric selection, dimension tags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from event_ml.functions.joins import join_small, materialise


def correlation_pairs(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """(feature_a, feature_b, r) for the strict lower triangle, one pass."""
    pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i)]
    row = df.agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    items = [
        F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.explode(F.array(*items)).alias("s")).select(
        "s.feature_a", "s.feature_b", F.round("s.r", digits).alias("r")
    )


def labelled_long(df: DataFrame, cols: Sequence[str], label_col: str) -> DataFrame:
    """(feature, label, value) with null/NaN values dropped."""
    stacked = df.select(
        F.col(label_col).alias("label"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
        ).alias("kv"),
    ).select("kv.feature", "label", "kv.value")
    return stacked.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _class_stats(df: DataFrame, cols: Sequence[str], label_col: str, stats: dict) -> DataFrame:
    """(feature, label, <stat>...) from ONE groupBy(label) over the wide rows
    (no explode: per-class statistics need no long form); null/NaN values
    are ignored like in ``labelled_long``."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [fn(v).alias(f"{i}__{name}") for name, fn in stats.items()]
    wide = df.groupBy(F.col(label_col).alias("label")).agg(*aggs)
    items = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{i}__{name}").alias(name) for name in stats])
        for i, c in enumerate(cols)
    ]
    return wide.select("label", F.explode(F.array(*items)).alias("s")).select("label", "s.*").select(
        "feature", "label", *stats
    )


def density_histogram(df: DataFrame, cols: Sequence[str], label_col: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram per (feature, class) over that class's own
    [min, max] (a constant column is widened to +-0.5); the last bin is
    right-closed; density = n / (N * width), so each histogram integrates
    to 1.  Empty bins are emitted with count 0.

    Two passes: min/max/N per (feature, class) -- a tiny table, joined back
    by broadcast -- then one partial+final count per (feature, class, bin).
    """
    long = labelled_long(df, cols, label_col)
    stats = _class_stats(
        df, cols, label_col,
        {"vmin": F.min, "vmax": F.max, "n": lambda c: F.count(c)},
    )
    stats = stats.select(
        "feature",
        "label",
        "n",
        F.when(F.col("vmin") == F.col("vmax"), F.col("vmin") - 0.5).otherwise(F.col("vmin")).alias("lo"),
        F.when(F.col("vmin") == F.col("vmax"), F.col("vmax") + 0.5).otherwise(F.col("vmax")).alias("hi"),
    )
    # one row per (feature, class); its bytes decide whether it is broadcast
    stats = materialise(stats, "class-ranges")
    binned = long.join(stats, ["feature", "label"]).select(
        "feature",
        "label",
        F.least(
            F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
            F.lit(bins - 1),
        ).cast("int").alias("bin"),
    )
    counts = binned.groupBy("feature", "label", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = stats.crossJoin(
        F.broadcast(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["feature", "label", "bin"], "left").select(
        "feature",
        "label",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        (F.coalesce(F.col("count"), F.lit(0)) / (F.col("n") * width)).alias("density"),
    )


def class_separation(df: DataFrame, cols: Sequence[str], label_col: str, digits: int = 6) -> DataFrame:
    """Standardised mean difference per feature:
    (mean1 - mean0) / sqrt((var1 + var0) / 2), sample variances."""
    st = _class_stats(df, cols, label_col, {"mean": F.avg, "var": F.var_samp})
    per = st.groupBy("feature").agg(
        F.max(F.when(F.col("label") == 1, F.col("mean"))).alias("mean_pos"),
        F.max(F.when(F.col("label") == 0, F.col("mean"))).alias("mean_neg"),
        F.max(F.when(F.col("label") == 1, F.col("var"))).alias("var_pos"),
        F.max(F.when(F.col("label") == 0, F.col("var"))).alias("var_neg"),
    )
    smd = F.try_divide(F.col("mean_pos") - F.col("mean_neg"), F.sqrt((F.col("var_pos") + F.col("var_neg")) / 2))
    return per.select(
        "feature",
        F.round("mean_pos", digits).alias("mean_pos"),
        F.round("mean_neg", digits).alias("mean_neg"),
        F.round(smd, digits).alias("smd"),
    )


def with_group_value(df: DataFrame, keys: Sequence[str], agg_expr, name: str) -> DataFrame:
    """Attach a per-group aggregate to every row (a FIXED level-of-detail
    value).  Implemented as aggregate + join instead of a window partitioned
    by the key: a window would put each group -- e.g. a class holding a
    third of all rows -- into a single task.  The aggregate is partial
    (map-side) and its bytes decide whether the join broadcasts it
    (``functions.joins.join_small``)."""
    agg = df.groupBy(*keys).agg(agg_expr.alias(name))
    return join_small(df, agg, list(keys), "left")


def unpivot_features(df: DataFrame, id_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Long form (ids..., feature_name, value)."""
    return df.unpivot(list(id_cols), list(cols), "feature_name", "value")


def group_sums(df: DataFrame, dims: Sequence[str], measures: dict[str, str], count: str | None = None) -> DataFrame:
    """SUM of measures by dimensions (``{alias: column}``), and the number of
    rows if ``count`` names a column for it; one aggregate."""
    rows = [F.count(F.lit(1)).alias(count)] if count else []
    return df.groupBy(*dims).agg(*[F.sum(c).alias(a) for a, c in measures.items()], *rows)


def count_sum_long(df: DataFrame, dims: Sequence[str], measure: str) -> DataFrame:
    """COUNT(rows) and SUM(measure) by dimension, stacked as
    (dims..., measure_name, value)."""
    wide = df.groupBy(*dims).agg(
        F.count(F.lit(1)).cast("double").alias("n_rows"),
        F.sum(measure).cast("double").alias(f"sum_{measure}"),
    )
    return wide.unpivot(list(dims), ["n_rows", f"sum_{measure}"], "measure_name", "value")


def select_metric(table: DataFrame, metric: str, key_cols: Sequence[str]) -> DataFrame:
    """Parameterised metric choice, validated against the schema."""
    numeric = {f.name for f in table.schema.fields if f.dataType.typeName() in ("double", "float", "long", "integer")}
    if metric not in numeric or metric in key_cols:
        raise ValueError(f"unknown metric {metric!r}; choose one of {sorted(numeric - set(key_cols))}")
    return table.select(*key_cols, F.lit(metric).alias("metric"), F.col(metric).cast("double").alias("value"))


def filter_by_selection(df: DataFrame, selection: DataFrame, key: str) -> DataFrame:
    """Cross-view action filter: keep rows whose key is selected (semi join)."""
    return join_small(df, selection.select(key).distinct(), key, "left_semi")


def tag_features(df: DataFrame, feature_col: str, dimension: DataFrame) -> DataFrame:
    """Attach (grp, ordinal) from a feature dimension table, broadcast if its bytes allow it."""
    return join_small(df, dimension.withColumnRenamed("name", feature_col), feature_col, "left").select(*df.columns, *[c for c in dimension.columns if c != "name"])
