"""Reproducible splits and samples.

``randomSplit`` / ``sample`` depend on the partitioning of their input, so
the same seed gives different rows after a repartition.  Here membership is a
pure function of a row key: u = md5(salt || key) as a 32-bit integer, and a
row belongs to split i when cut[i-1] <= u < cut[i] with integer cut points.
No shuffle, no window, no skew: every task decides for its own rows.
Weights are normalised to sum 1 (``randomSplit([0.12, 0.8])`` means
13.04% / 86.96%, not "ignore the remaining 8%").
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from event_ml.functions.columns import col, hash_u32
from event_ml.functions.joins import materialise

TWO32 = 1 << 32


def normalised_cuts(weights: Sequence[float]) -> list[int]:
    """Integer cut points in [0, 2^32] for the normalised weights."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    cuts, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        cuts.append(int(round(acc * TWO32)))
    cuts.append(TWO32)
    return cuts


def _marked(key: Column) -> Column:
    """The key as a string; a null key is the empty one."""
    return F.coalesce(key.cast("string"), F.lit(""))


def key_hash(key: str | Column, salt: str = "") -> Column:
    """32-bit hash of the salted key; rows with a null key hash alike."""
    k = _marked(col(key))
    if salt:
        k = F.concat(F.lit(salt), k)
    return hash_u32(k)


def split_index(key: str | Column, weights: Sequence[float], salt: str = "") -> Column:
    """0-based split index of a row (a balanced CASE chain on the hash)."""
    h = key_hash(key, salt)
    cuts = normalised_cuts(weights)
    expr = F.lit(len(cuts) - 1)
    for i in range(len(cuts) - 2, -1, -1):
        expr = F.when(h < F.lit(cuts[i]), F.lit(i)).otherwise(expr)
    return expr


def hash_split(df: DataFrame, key: str, weights: Sequence[float], salt: str = "") -> list[DataFrame]:
    """One DataFrame per weight; disjoint, complete, partition-independent."""
    tagged = df.withColumn("_split", split_index(key, weights, salt))
    return [tagged.filter(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def with_split(df: DataFrame, key: str, names: Sequence[str], weights: Sequence[float], salt: str = "") -> DataFrame:
    """Adds a ``split`` name column."""
    idx = split_index(key, weights, salt)
    name = F.element_at(F.array(*[F.lit(n) for n in names]), idx + 1)
    return df.withColumn("split", name)


def stratified_split(
    df: DataFrame,
    key: str,
    label_col: str,
    names: Sequence[str],
    weights: Sequence[float],
    salt: str = "",
) -> DataFrame:
    """Per-class split: the class value is part of the hash salt, so each
    class is cut independently at the same proportions (no per-class window,
    no skew from a dominant class).  Equivalent to splitting every class and
    taking the union."""
    k = F.concat_ws("|", F.lit(salt), col(label_col).cast("string"), col(key).cast("string"))
    return with_split(df, k, names, weights)


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "") -> DataFrame:
    """Deterministic Bernoulli sample: keep rows with u < fraction."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    cut = int(round(fraction * TWO32))
    return df.filter(key_hash(key, salt) < F.lit(cut))


def capped_fraction(n_rows: int, max_rows: int) -> float:
    """fraction = min(1, max_rows / n) of a capped sample."""
    return 1.0 if n_rows <= 0 else min(1.0, max_rows / n_rows)


def _bins(df: DataFrame, value: Column, weight: Column) -> list[tuple[int, int]]:
    """(bin, rows) in order, of rows whose bin isn't null."""
    binned = df.select(value.alias("b"), weight.alias("n")).groupBy("b").agg(F.sum("n").alias("n"))
    return [tuple(r) for r in binned.where("b IS NOT NULL").orderBy("b").collect()]


def _holding(bins: list[tuple[int, int]], below: int, k: int) -> tuple[int, int]:
    """(bin that holds the k-th row, rows before it)."""
    for b, n in bins:
        if below + n >= k:
            return b, below
        below += n
    raise ValueError("fewer than k rows")


def _narrowed(df: DataFrame, value: Column, bits: int, k: int, bits_per_pass: int, weight: Column | None = None) -> tuple[int, int]:
    """(v, below) of the k-th smallest ``value`` (an unsigned integer of that
    many bits): v itself and the number of rows below it.  Each pass counts the
    rows of at most 2^bits_per_pass bins of the range that holds the k-th;
    ``weight`` counts for so many rows."""
    lo, below = 0, 0
    while bits:
        shift = max(0, bits - bits_per_pass)
        off = value - F.lit(lo)
        # rows outside the range have a null bin; the value is used once
        bins = _bins(df, F.when(F.shiftright(off, bits) == 0, F.shiftright(off, shift)), F.lit(1) if weight is None else weight)
        b, below = _holding(bins, below, k)
        lo, bits = lo + (b << shift), shift
    return lo, below


def smallest_by_hash(
    df: DataFrame,
    key: str,
    k: int | Callable[[int], int],
    salt: str = "",
    bits_per_pass: int = 16,
) -> DataFrame:
    """Exactly ``k`` rows: those with the smallest (hash, key).

    Same rows as ``ORDER BY hash, key LIMIT k`` without a global sort or a
    k-row merge in one task; a null key is an empty one.  One pass counts
    2^bits_per_pass bins of the 32-bit hash, and so the rows too (``k`` may be a
    function of their number); a second writes the keys of the bin that holds
    the k-th row, and its hash h* is found among them.  Rows below h* are in; at
    h* the keys' counts decide, so rows are never fetched: one more pass
    returns them.  Of several rows with the last key, those with the smallest
    64-bit hash of all their columns are in, and of equal rows as many as are
    still wanted.
    """
    hashed = df.withColumn("_h", key_hash(key, salt)).withColumn("_k", _marked(col(key)))
    rest = max(0, 32 - bits_per_pass)
    bins = _bins(hashed, F.shiftright("_h", rest), F.lit(1))
    n = sum(rows for _, rows in bins)
    k = k(n) if callable(k) else k
    if k <= 0:
        return df.limit(0)
    if k >= n:
        return df
    # the keys of the bin that holds the k-th row are written: about n / 2^bits_per_pass rows
    at, under = _holding(bins, 0, k)
    inside = hashed.where(F.shiftright("_h", rest) == at).groupBy("_h", "_k").agg(F.count(F.lit(1)).alias("n"))
    inside = materialise(inside, "sample-edge")
    low, more = _narrowed(inside, F.col("_h") - F.lit(at << rest), rest, k - under, bits_per_pass, F.col("n"))
    cut, below = (at << rest) + low, under + more
    sure = hashed.where(F.col("_h") < cut).select(*df.columns)
    edge = hashed.where(F.col("_h") == cut)
    # one row a key with this hash: about n / 2^32 of them
    running = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = inside.where(F.col("_h") == cut).select("_k", "n", F.sum("n").over(running).alias("upto"))
    last = keys.where(F.col("upto") >= k - below).orderBy("upto").first()
    if last["upto"] == k - below:
        return hashed.where((F.col("_h") < cut) | ((F.col("_h") == cut) & (F.col("_k") <= last["_k"]))).select(*df.columns)
    sure = sure.unionByName(edge.where(F.col("_k") < last["_k"]).select(*df.columns))
    wanted = k - below - (last["upto"] - last["n"])
    same = edge.where(F.col("_k") == last["_k"]).select(*df.columns)
    same = same.withColumn("_r", F.shiftrightunsigned(F.xxhash64(*df.columns), 1))
    cut, below = _narrowed(same, F.col("_r"), 63, wanted, bits_per_pass)
    equal = same.where(F.col("_r") == cut).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    # equal rows are made anew, as many as wanted
    upto = F.sum("_n").over(Window.orderBy(F.to_json(F.struct(*df.columns))).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    take = F.greatest(F.lit(0), F.least(F.col("_n"), F.lit(wanted - below) - (F.col("_upto") - F.col("_n"))))
    again = equal.withColumn("_upto", upto).withColumn("_take", take.cast("int"))
    again = again.where("_take > 0").select(*df.columns, F.explode(F.sequence(F.lit(1), F.col("_take")))).select(*df.columns)
    return sure.unionByName(same.where(F.col("_r") < cut).select(*df.columns)).unionByName(again)
