"""Feature pipeline: derived columns as a persistable custom Transformer,
vector assembly with a kept/dropped report, standardisation (MLlib and its
SQL twin), PCA with cumulative explained variance, label casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.columns import flag_count, safe_ratio
from event_ml.schema import ENGINEERED_FEATURES


class EventFeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds exactly five derived columns in one projection:

    1. ratio       = ratio_num / (ratio_den + 1e-6)
    2. sum         = sum of ``sum_cols`` (null if any input is null)
    3. flag count  = number of ``flag_cols[i] > flag_thresholds[i]``
    4. ratio 2     = ratio2_num / (ratio2_den + 1e-6)
    5. abs diff    = |diff_a - diff_b|

    Defaults are the event-table columns; every input and output name is a
    Param, so the same transformer runs on any table.  Divisions use
    ``try_divide`` (null instead of an ANSI error).  Stateless: it runs
    unchanged on a streaming DataFrame.
    """

    ratio_num = Param(Params._dummy(), "ratio_num", "numerator of ratio 1", TypeConverters.toString)
    ratio_den = Param(Params._dummy(), "ratio_den", "denominator of ratio 1", TypeConverters.toString)
    sum_cols = Param(Params._dummy(), "sum_cols", "columns summed", TypeConverters.toListString)
    flag_cols = Param(Params._dummy(), "flag_cols", "columns flagged", TypeConverters.toListString)
    flag_thresholds = Param(Params._dummy(), "flag_thresholds", "flag thresholds", TypeConverters.toListFloat)
    ratio2_num = Param(Params._dummy(), "ratio2_num", "numerator of ratio 2", TypeConverters.toString)
    ratio2_den = Param(Params._dummy(), "ratio2_den", "denominator of ratio 2", TypeConverters.toString)
    diff_a = Param(Params._dummy(), "diff_a", "first column of |a-b|", TypeConverters.toString)
    diff_b = Param(Params._dummy(), "diff_b", "second column of |a-b|", TypeConverters.toString)
    output_cols = Param(Params._dummy(), "output_cols", "five output names", TypeConverters.toListString)
    epsilon = Param(Params._dummy(), "epsilon", "added to denominators", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(
            ratio_num="lepton_pT",
            ratio_den="jet1_pT",
            sum_cols=["jet1_pT", "jet2_pT", "jet3_pT", "jet4_pT"],
            flag_cols=["jet1_b_tag", "jet2_b_tag", "jet3_b_tag", "jet4_b_tag"],
            flag_thresholds=[0.5, 0.5, 0.5, 0.5],
            ratio2_num="m_bb",
            ratio2_den="m_wwbb",
            diff_a="jet1_eta",
            diff_b="jet2_eta",
            output_cols=list(ENGINEERED_FEATURES),
            epsilon=1e-6,
        )
        self._set(**self._input_kwargs)

    @keyword_only
    def setParams(self, **kwargs):
        return self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        g = self.getOrDefault
        eps = g(self.epsilon)
        names = g(self.output_cols)
        if len(names) != 5:
            raise ValueError("output_cols must name exactly five columns")
        flags, thr = g(self.flag_cols), g(self.flag_thresholds)
        if len(flags) != len(thr):
            raise ValueError("flag_cols and flag_thresholds differ in length")
        total = None
        for c in g(self.sum_cols):
            total = F.col(c) if total is None else total + F.col(c)
        return dataset.withColumns(
            {
                names[0]: safe_ratio(g(self.ratio_num), g(self.ratio_den), eps),
                names[1]: total,
                names[2]: flag_count(F.col(c) > F.lit(t) for c, t in zip(flags, thr)),
                names[3]: safe_ratio(g(self.ratio2_num), g(self.ratio2_den), eps),
                names[4]: F.abs(F.col(g(self.diff_a)) - F.col(g(self.diff_b))),
            }
        )


def cast_label(df: DataFrame, label_col: str = "label", keep_raw: str | None = "raw_label") -> DataFrame:
    """label -> double (MLlib), optionally keeping the original as raw_label."""
    if keep_raw:
        df = df.withColumnRenamed(label_col, keep_raw)
        return df.withColumn(label_col, F.col(keep_raw).cast("double"))
    return df.withColumn(label_col, F.col(label_col).cast("double"))


def valid_row(cols: Sequence[str]):
    """Row predicate of VectorAssembler(handleInvalid='skip'): no null, no NaN."""
    cond = F.lit(True)
    for c in cols:
        x = F.col(c)
        cond = cond & x.isNotNull() & ~F.coalesce(F.isnan(x), F.lit(False))
    return cond


def assemble(df: DataFrame, cols: Sequence[str], output: str = "features", skip_invalid: bool = True) -> DataFrame:
    return VectorAssembler(
        inputCols=list(cols), outputCol=output, handleInvalid="skip" if skip_invalid else "error"
    ).transform(df)


def assembler_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(n_rows, n_kept, n_dropped) of a skip-invalid assembly, one pass."""
    ok = valid_row(cols)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(ok).cast("long").alias("n_kept"),
        F.count_if(~ok).cast("long").alias("n_dropped"),
    )


def fit_scaler(train: DataFrame, input_col: str = "features", output_col: str = "scaled"):
    """StandardScaler(withMean, withStd): mean 0, SAMPLE std 1 (fit on train)."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True).fit(train)


def prep_pipeline(cols: Sequence[str], output_col: str = "features") -> Pipeline:
    """assemble (skip invalid) -> standardise, as one MLlib Pipeline."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(cols), outputCol="raw_features", handleInvalid="skip"),
            StandardScaler(inputCol="raw_features", outputCol=output_col, withMean=True, withStd=True),
        ]
    )


def standardise_columns(
    df: DataFrame, cols: Sequence[str], stats_from: DataFrame | None = None, keep_stats: bool = False
) -> DataFrame:
    """SQL twin of StandardScaler on plain columns: (x - mean) / stddev_samp,
    0 for a constant column.  Statistics come from ``stats_from`` (the train
    split) and are attached with a broadcast cross join of one row;
    ``keep_stats`` leaves them as ``_mu_<c>`` and ``_sd_<c>``."""
    src = stats_from if stats_from is not None else df
    stats = src.agg(
        *[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_samp(c).alias(f"_sd_{c}") for c in cols]
    )
    joined = df.crossJoin(F.broadcast(stats))
    scaled = {
        c: F.when(F.col(f"_sd_{c}") == 0, F.lit(0.0)).otherwise(
            (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}")
        )
        for c in cols
    }
    if keep_stats:
        return joined.withColumns(scaled)
    return joined.withColumns(scaled).drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def fit_pca(df: DataFrame, input_col: str, k: int, target: float = 0.95):
    """(model, its table): (component, explained_variance, cumulative,
    reached_target) of PCA(k).  The k-row table is built from the model's
    vector; the running sum is a window over those k rows only."""
    model = PCA(k=k, inputCol=input_col, outputCol="_pca").fit(df)
    ev = [float(x) for x in model.explainedVariance.toArray()]
    spark = df.sparkSession
    t = spark.createDataFrame([(i + 1, v) for i, v in enumerate(ev)], "component int, explained_variance double")
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    table = t.select(
        "component",
        "explained_variance",
        F.sum("explained_variance").over(w).alias("cumulative"),
    ).withColumn("reached_target", F.col("cumulative") >= F.lit(target))
    return model, table


def pca_variance(df: DataFrame, input_col: str, k: int, target: float = 0.95) -> DataFrame:
    """The table of ``fit_pca``."""
    return fit_pca(df, input_col, k, target)[1]
