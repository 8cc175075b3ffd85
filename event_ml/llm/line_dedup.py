"""Removal of repeated line runs by a suffix array over line ids.

All documents' lines are numbered in one order (``place``: documents by id, then
by text, with a free number between them).  Suffixes are sorted into classes by
prefix doubling: at level k a class holds the places where the same ``2**k``
lines follow, and is named by its earliest place, so names are exact.  Level
k + 1 pairs the name at a place with the name ``2**k`` places on, which the free
numbers keep inside the document.  Only suffixes whose class has two places or
more stay, so each level is smaller than the one before; the levels end when
none is left.

A suffix's longest common prefix with an earlier suffix is then built from the
levels, largest first: it grows by ``2**k`` lines while the grown run's class
has an earlier place.  Those are the maximal repeated runs.  A run that isn't
blank is deleted everywhere but at its earliest place.

Texts are split and hashed once.  A class with very many places is spread over
several tasks where its places look up its name.  Everything here is DataFrame
operations; each level is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from event_ml.functions.prefix import ordered_prefix
from event_ml.llm.common import staged, table

#: A document's key: its id with nulls last, and a hash of its text.
DOC = ["no_id", "id", "th"]
#: A class of a ``HEAVY``-th of all places or more is spread over ``SPREAD`` tasks; there are at most ``HEAVY``.
HEAVY, SPREAD = 1000, 64


def _key(id_col: str, text_col: str) -> list[Column]:
    own = F.col(id_col).cast("long")
    return [own.isNull().alias("no_id"), F.coalesce(own, F.lit(0)).alias("id"), F.xxhash64(text_col).alias("th")]


def _named(rows: DataFrame, group: list[str], name: str, heavy: int) -> DataFrame:
    """Rows (place, ...) whose ``group`` has two places or more, with the earliest one as ``name``.

    A group of ``heavy`` rows or more is looked up in parts: its rows by a hash
    of their place, its name once for every part.
    """
    found = rows.groupBy(*group).agg(F.min("place").alias(name), F.max("place").alias("_last"), F.count("*").alias("_n"))
    found = found.where(F.col(name) != F.col("_last")).drop("_last")
    few = found.where(F.col("_n") >= heavy).select(*group, F.lit(True).alias("_heavy"))
    part = F.when(F.col("_heavy"), F.pmod(F.xxhash64("place"), F.lit(SPREAD))).otherwise(0).cast("int")
    parts = F.when(F.col("_n") >= heavy, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    spread = found.select(*group, name, F.explode(parts).alias("_part"))
    marked = rows.join(F.broadcast(few), group, "left").withColumn("_part", part).drop("_heavy")
    return marked.join(spread, [*group, "_part"]).drop("_part")


def numbered_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(no_id, id, th, start, lines): each distinct document's line hashes, and its first line's place."""
    one = lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), F.length(F.trim(x)).alias("chars"))
    hashed = docs.where(F.col(text_col).isNotNull()).select(*_key(id_col, text_col), F.transform(F.split(text_col, "\n"), one).alias("lines"))
    hashed = staged(hashed, "line-hashes")
    sizes = hashed.select(*DOC, (F.size("lines").cast("long") + 1).alias("room")).distinct()
    starts = ordered_prefix(sizes, DOC, ["room"]).select(*DOC, (F.col("room_cum") - F.col("room")).alias("start"))
    return staged(hashed.join(starts, DOC), "line-numbers")


def repeated_lines(numbered: DataFrame) -> tuple[DataFrame, int]:
    """Level 0, (start, place, chars, name) of every place of a line that has two
    places or more, and the rows from which on a class is heavy at any level."""
    places = numbered.select("start", F.posexplode("lines").alias("pos", "l")).select("start", (F.col("start") + F.col("pos")).alias("place"), "l.*")
    total = numbered.agg(F.sum(F.size("lines"))).first()[0] or 0
    heavy = max(1000, total // HEAVY)
    level = _named(places, ["h1", "h2"], "name", heavy)
    # rows that are the same document have the same places
    return staged(level.select("start", "place", "chars", "name").distinct(), "line-level"), heavy


def doubled(level: DataFrame, k: int, heavy: int) -> DataFrame:
    """Level k + 1 from level k."""
    ahead = level.select((F.col("place") - (1 << k)).alias("place"), F.col("name").alias("next"))
    pairs = level.select("place", F.col("name").alias("half")).join(ahead, "place")
    return staged(_named(pairs, ["half", "next"], "name", heavy).select("place", "name"), "line-level")


def _wanted(members: DataFrame) -> DataFrame:
    """The classes in which some place still looks for its longest run."""
    return members.join(members.where("mine").select("n", "name").distinct(), ["n", "name"], "left_semi")


def _grown(members: DataFrame, level: DataFrame, k: int, heavy: int) -> DataFrame:
    """``members`` after each run was tried with ``2**k`` lines more.

    A class (length n, earliest place) holds all its places, since any of them
    may be the earlier copy of a longer run; ``mine`` marks those whose own
    longest run so far has this length.
    """
    ahead = level.select(F.col("place").alias("at"), F.col("name").alias("next"))
    tried = members.withColumn("at", F.col("place") + F.col("n")).join(ahead, "at")
    found = _named(tried.drop("at"), ["n", "name", "next"], "longer", heavy).select(
        "place", "n", F.col("longer").alias("name"), (F.col("mine") & (F.col("place") != F.col("longer"))).alias("mine")
    )
    found = staged(found, "line-runs")
    gone = found.where("mine").select("place", "n", F.lit(True).alias("gone"))
    stayed = members.join(gone, ["place", "n"], "left").withColumn("mine", F.col("mine") & F.col("gone").isNull()).drop("gone")
    longer = found.withColumn("n", F.col("n") + (1 << k))
    return staged(_wanted(stayed).unionByName(_wanted(longer)), "line-runs")


def repeated_runs(levels: list[DataFrame], heavy: int) -> DataFrame:
    """(place, n): for every place that has one, the longest run of ``n`` lines
    that begins there and at an earlier place."""
    later = lambda level: level.where(F.col("place") != F.col("name"))
    members = None
    for k in range(len(levels) - 1, 0, -1):
        if members is not None:
            members = _grown(members, levels[k], k, heavy)
        own = later(levels[k]).select("place")
        if k + 1 < len(levels):
            own = own.join(later(levels[k + 1]).select("place"), "place", "left_anti")
        begun = levels[k].select("place", "name", F.lit(1 << k).cast("long").alias("n"))
        begun = _wanted(begun.join(own.withColumn("own", F.lit(True)), "place", "left").withColumn("mine", F.col("own").isNotNull()).drop("own"))
        members = begun if members is None else members.unionByName(begun)
        members = staged(members, "line-runs")
    single = later(levels[0]).select("place", F.lit(1).cast("long").alias("n"))
    if members is None:
        return single
    runs = _grown(members, levels[0], 0, heavy).where("mine").select("place", "n")
    return runs.unionByName(single.join(runs, "place", "left_anti"))


def repeated_places(numbered: DataFrame, min_chars: int) -> DataFrame:
    """(start, pos) of every line in a repeated run of ``min_chars`` characters that are no outer blanks."""
    level, heavy = repeated_lines(numbered)
    levels = [level]
    while not levels[-1].isEmpty():
        levels.append(doubled(levels[-1], len(levels) - 1, heavy))
    runs = repeated_runs(levels[:-1] or levels, heavy)
    in_doc = Window.partitionBy("start").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    summed = levels[0].select("start", "place", "chars", F.sum("chars").over(in_doc).alias("upto"))
    ends = summed.select(F.col("place").alias("last"), F.col("upto").alias("end_upto"))
    sized = runs.withColumn("last", F.col("place") + F.col("n") - 1).join(ends, "last")
    sized = summed.join(sized, "place", "left").withColumn("long", F.col("end_upto") - F.col("upto") + F.col("chars") >= min_chars)
    reach = F.max(F.when(F.col("long"), F.col("last"))).over(in_doc)
    return sized.select("start", "place", reach.alias("reach")).where("reach >= place").select("start", (F.col("place") - F.col("start")).cast("int").alias("pos"))


def dedup_lines(docs: DataFrame, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its texts after deletion, and n_lines, n_deleted (null text: null).

    A line goes if it is in a run of lines that begins at an earlier place too
    and has ``min_chars`` characters, outer blanks of lines not counted: by
    default every run that isn't blank.  Texts are split at newlines, however
    long they are; what stays is joined by them, so a text without repeats is
    unchanged, an empty text has one blank line and stays, and one that is all
    repeats becomes empty.  Rows with the same id and text are one document and
    have the same result.  Null ids come last; rows that share an id are ordered
    by a hash of their texts.  Columns named n_lines or n_deleted are replaced;
    others stay, whatever their names.  An empty table gives no rows.
    """
    numbered = numbered_lines(docs, id_col, text_col)
    gone = repeated_places(numbered, min_chars).groupBy("start").agg(F.collect_set("pos").alias("gone"))
    gone = numbered.select("start", *DOC).distinct().join(gone, "start")
    gone = staged(gone.select(*[F.col(c).alias(f"_llm_{c}") for c in DOC], F.col("gone").alias("_llm_gone")), "deleted-lines")
    keys = [k.alias(f"_llm_{c}") for c, k in zip(DOC, _key(id_col, text_col))]
    columns = [c for c in docs.columns if c not in (text_col, "n_lines", "n_deleted")]
    split = docs.select(*columns, *keys, F.split(text_col, "\n").alias("_llm_lines"))
    joined = split.join(gone, [f"_llm_{c}" for c in DOC], "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_llm_lines") - 1), "_llm_gone")
    rest = F.transform(stay, lambda i: F.get("_llm_lines", i))
    text = F.array_join(F.when(F.col("_llm_gone").isNull(), F.col("_llm_lines")).otherwise(rest), "\n")
    n_lines = F.when(F.col("_llm_lines").isNotNull(), F.size("_llm_lines"))
    n_deleted = F.when(F.col("_llm_lines").isNotNull(), F.coalesce(F.size("_llm_gone"), F.lit(0)))
    out = {c: F.col(c) for c in columns} | {text_col: text}
    kept = [out[c].alias(c) for c in docs.columns if c in out]
    return joined.select(*kept, n_lines.alias("n_lines"), n_deleted.alias("n_deleted"))


def op7_line_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")
