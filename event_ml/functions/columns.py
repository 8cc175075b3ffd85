"""Column-expression helpers.  All are built-in Spark expressions (JVM side,
whole-stage codegen); nothing here runs Python per row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_u32(key: ColumnOrName) -> Column:
    """First 32 bits of md5(key) as a non-negative BIGINT (0 .. 2^32-1).

    Deterministic, independent of partitioning and of the engine: the same
    value is ``('0x' || substr(md5(k), 1, 8))::BIGINT`` in DuckDB.
    """
    return F.conv(F.substring(F.md5(col(key).cast("string")), 1, 8), 16, 10).cast("bigint")


def safe_ratio(num: ColumnOrName, den: ColumnOrName, eps: float = 1e-6) -> Column:
    """num / (den + eps); null instead of an ANSI division error."""
    return F.try_divide(col(num), col(den) + F.lit(eps))


def flag_count(conditions: Iterable[Column]) -> Column:
    """Number of true conditions (null if any input is null)."""
    total = None
    for c in conditions:
        term = c.cast("int")
        total = term if total is None else total + term
    return total if total is not None else F.lit(0)


def is_invalid(c: ColumnOrName, check_inf: bool = True) -> Column:
    """Null, NaN or (optionally) +/-Infinity."""
    x = col(c)
    cond = x.isNull() | F.isnan(x)
    if check_inf:
        cond = cond | (F.abs(x) == F.lit(float("inf")))
    return F.coalesce(cond, F.lit(True))


def nan_to_null(c: ColumnOrName) -> Column:
    return F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))


def vector_string(vec_col: ColumnOrName, fmt: str = "%.6f") -> Column:
    """Dense vector -> one comma-joined string of formatted components."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(col(vec_col))
    return F.concat_ws(",", F.transform(arr, lambda x: F.format_string(fmt, x)))


def array_string(arr_col: ColumnOrName, fmt: str = "%.6f") -> Column:
    return F.concat_ws(",", F.transform(col(arr_col), lambda x: F.format_string(fmt, x)))


def count_at_least(thresholds: Sequence[float], score: ColumnOrName) -> Column:
    """Number of sorted thresholds t with t <= score (0..len(thresholds)).

    Built as a balanced binary search of nested CASE expressions (about
    log2(n) comparisons per row, fully code-generated) instead of a per-row
    higher-order function over an array, which is interpreted.
    A null score maps to null.
    """
    thr = sorted(float(t) for t in thresholds)

    if isinstance(score, str):
        # One SQL expression: a single driver call instead of hundreds of
        # Column-API calls (each costs milliseconds on the driver).
        s = "CAST(`" + score.replace("`", "``") + "` AS DOUBLE)"

        def search_sql(lo: int, hi: int) -> str:
            # answer lies in [lo, hi]; thr[lo-1] <= s < thr[hi] already known
            if lo == hi:
                return str(lo)
            mid = (lo + hi + 1) // 2
            t = sql_literal(thr[mid - 1], "double")
            return f"CASE WHEN {s} >= {t} THEN {search_sql(mid, hi)} ELSE {search_sql(lo, mid - 1)} END"

        return F.expr(f"CASE WHEN {s} IS NULL THEN CAST(NULL AS INT) ELSE {search_sql(0, len(thr))} END")

    sc = col(score).cast("double")

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(sc >= F.lit(thr[mid - 1]), search(mid, hi)).otherwise(search(lo, mid - 1))

    return F.when(sc.isNull(), F.lit(None).cast("int")).otherwise(search(0, len(thr)))


def sql_literal(value, type_name: str) -> str:
    """A typed SQL literal (NULL, NaN and infinities included)."""
    if value is None:
        return f"CAST(NULL AS {type_name})"
    if type_name in ("double", "float"):
        v = float(value)
        if v != v:
            text = "NaN"
        elif v in (float("inf"), float("-inf")):
            text = "Infinity" if v > 0 else "-Infinity"
        else:
            text = repr(v)
        return f"CAST('{text}' AS {type_name})"
    if type_name == "string":
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if type_name == "boolean":
        return "true" if value else "false"
    return f"CAST({int(value)} AS {type_name})"


def literal_table(spark, rows: Sequence[Sequence], schema: str) -> "DataFrame":
    """A small literal table built JVM-side (``inline`` of an array of
    structs on a one-row range), written as ONE SQL expression: unlike
    ``createDataFrame(list)`` it needs no Python worker to scan, and unlike
    per-value Column calls it costs one driver round trip.
    ``schema`` is a DDL string such as ``"idx int, threshold double"``."""
    fields = [tuple(part.strip().split()) for part in schema.split(",")]
    if not rows:
        return spark.range(0).selectExpr(*[f"{sql_literal(None, t)} AS {n}" for n, t in fields])
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{n}', {sql_literal(v, t)}" for v, (n, t) in zip(row, fields)) + ")"
        for row in rows
    )
    return spark.range(1).selectExpr(f"inline(array({structs}))")


def pct_half_up(count: ColumnOrName, total: ColumnOrName, digits: int = 2) -> Column:
    """count / total * 100 rounded half-up, in exact integer arithmetic:
    floor((2 c 10^(d+2) + t) / 2t) / 10^d, with integer division.  Percentages
    of counts often end exactly on a 5, where rounding the binary double is
    engine-dependent."""
    scale = F.lit(2 * 10 ** (digits + 2)).cast("decimal(18,0)")
    c, t = col(count).cast("decimal(19,0)"), col(total).cast("decimal(19,0)")
    return F.call_function("div", c * scale + t, t + t) / F.lit(float(10**digits))
