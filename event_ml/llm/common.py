"""What the operators of this package share.

Intermediate tables go to the shared folder that ``spark.checkpoint.dir``
names (``ensure_checkpoint_dir``), so lineage is cut by files that every
executor can read again after another one is lost.
"""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import event_ml
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from event_ml.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the session's shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)``; executors get this package first, once an application."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(event_ml.__file__).parent
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/event_ml_package", "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(run, schema)


_KEPT: dict = {}


def kept_in_worker(kind, make: Callable):
    """``make()``'s value, kept by a Python worker from task to task until it
    needs a value of another ``kind``: only one is in memory."""
    if kind not in _KEPT:
        _KEPT.clear()
        _KEPT[kind] = make()
    return _KEPT[kind]


def open_store(uri: str):
    """(filesystem, path) of a file URI; Spark's ``file:/x`` form is accepted."""
    from pyarrow import fs

    if re.match(r"[a-z][a-z0-9+.-]*:", uri):
        return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", uri))
    return fs.LocalFileSystem(), uri


def connected_components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long), root the smallest
    node that it can reach.

    Alternating large-star and small-star steps: each rewires links towards
    the smallest neighbour, keeps at most as many links as there were, and the
    number of rounds is logarithmic in the longest path.  Every round is
    written to the shared folder; the driver sees two numbers a round.
    """
    now = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        label,
    )
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(down, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            down.select("u", F.col("m").alias("v"))
        )
        now = staged(small.where("u <> v").distinct(), label)


def most_frequent(counts: DataFrame, n_col: str, at_most: int) -> DataFrame:
    """The rows of ``counts`` above a level of ``n_col`` that at most ``at_most`` rows reach."""
    level = F.floor(F.log2(F.col(n_col)) * 8)
    sizes = sorted(((r[0], r[1]) for r in counts.groupBy(level.alias("level")).agg(F.count("*")).collect()), reverse=True)
    total, least = 0, None
    for at, n in sizes:  # a few hundred levels at any input
        total += n
        if total > at_most:
            break
        least = at
    return counts.where(level >= F.lit(least)) if least is not None else counts.where("false")


def join_weighted(big: DataFrame, small: DataFrame, key: str, weight: str, heavy: int = 2000, hint: str | None = None) -> DataFrame:
    """``big`` joined with ``small`` (a row a ``key``; ``weight``: its rows in ``big``).

    Keys with a ``heavy``-th of all rows or more are at most ``heavy`` many:
    their rows of ``small`` are broadcast, so a common key isn't shuffled to one
    task.  The other rows are joined as ``hint`` says, else as Spark sees fit.  Both tables are read
    twice and should be written ones.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    often = F.col(weight) * heavy >= F.lit(total)
    few = small.where(often)
    rest = small.where(~often)
    others = big.join(F.broadcast(few.select(key)), key, "left_anti").join(rest.hint(hint) if hint else rest, key)
    return big.join(F.broadcast(few), key).unionByName(others)


def previous_in_order(ids: DataFrame, key: str, label: str) -> DataFrame:
    """(key, before): for every distinct value of ``key`` (a long, not null) the
    next smaller one, for the smallest value the largest.

    The values are range-partitioned once and written with their partition's
    number; a window looks back inside each partition, and a table with one row
    a partition (as many as ``spark.sql.shuffle.partitions``) joins the ends.
    """
    parts = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.select(key).distinct().repartitionByRange(parts, key)
    ranged = staged(ranged.withColumn("part", F.spark_partition_id()), label)
    ends = ranged.groupBy("part").agg(F.max(key).alias("largest"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = F.coalesce(F.lag("largest").over(Window.orderBy("part")), F.max("largest").over(every))
    inside = F.lag(key).over(Window.partitionBy("part").orderBy(key)).alias("inside")
    return (
        ranged.select("part", key, inside)
        .join(F.broadcast(ends.select("part", carry.alias("carry"))), "part")
        .select(key, F.coalesce("inside", "carry").alias("before"))
    )
