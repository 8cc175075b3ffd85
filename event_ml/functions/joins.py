"""Joins against aggregated tables whose size Spark itself checks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from event_ml.session import ensure_checkpoint_dir


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """``df`` written as Parquet to the session's shared folder and read back.

    Nothing is persisted on executors, lineage is cut by files that survive a
    lost executor, and the planner knows the table's size in bytes.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/event_ml-tables/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    """Join ``big`` with an aggregated ``small`` side.

    The small side is written first, so ``spark.sql.autoBroadcastJoinThreshold``
    compares its bytes: below it the join broadcasts (``big`` isn't shuffled,
    and a class with a third of all rows stays spread); above it the join
    shuffles and AQE splits skewed partitions.
    """
    return big.join(materialise(small, "join-side"), on, how)
