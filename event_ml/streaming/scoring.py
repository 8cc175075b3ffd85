"""Scoring new event files as they arrive.

The feature transformer and a fitted model (or whole PipelineModel) are
stateless row-wise stages, so the batch plan runs unchanged on a streaming
DataFrame: file source -> derived columns -> assemble -> scale -> predict ->
Parquet sink, with progress kept in a checkpoint on shared storage for
exactly-once output.  No stateful operator is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from event_ml.operators.models import score_column


def event_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Streaming scan of a folder; the schema is declared (no inference)."""
    return spark.readStream.schema(schema).format(fmt).load(path)


def score(df: DataFrame, stages: Sequence[Transformer], keep: Sequence[str] = ()) -> DataFrame:
    """Apply fitted stateless stages; output (keep..., prob_1, prediction)."""
    out = df
    for stage in stages:
        out = stage.transform(out)
    return out.select(*keep, score_column(out).alias("prob_1"), F.col("prediction"))


def start_scoring(
    scored: DataFrame,
    output_path: str,
    checkpoint_path: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Append the scored rows to Parquet; ``available_now`` processes what is
    there in bounded micro-batches and stops."""
    writer = (
        scored.writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
