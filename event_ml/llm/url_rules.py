"""URL filtering by given host and path rules and by mined association rules.

Given rules judge the URLs that they fit.  Those verdicts are labels: Spark's
FP-growth mines combinations of URL tokens that occur together with a verdict,
and rules with enough support and confidence judge the other URLs.

* Tokens: the host's labels, the top-level domain and the last two labels, and
  the path's words, with digits as ``0``.
* A mined rule is dropped if one with fewer tokens has the same verdict and at
  least its confidence.
* So tokens that occur in exactly the same labelled URLs are one item, since no
  rule that stays has two of them.  A token whose URLs all have one verdict, or
  that all labelled URLs have, is in no longer rule that stays: its own rule is
  counted, and it isn't mined.  What FP-growth combines are the other items.
* Rules are found by an inverted index: each is kept under its rarest item,
  and looked at only for URLs that have this item.  URLs with the same tokens
  are judged once, so a common host is one row here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from event_ml.llm.common import join_weighted, map_batches, staged, table

#: (verdict, host and path) of the query's rules.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VERDICT = "verdict="


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The parts after the first ``://``; both empty where there is none."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.

    Of equally long rules the one with the longer host counts, then the first in order.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/"), r[1], r[0]))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in reversed(ordered):
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(host: Column, path: Column) -> Column:
    """The URL's distinct tokens in order; none for an empty host and path."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    ends = F.when(F.size(labels) > 0, F.array(F.concat(F.lit("top="), F.element_at(labels, -1)), F.concat(F.lit("site="), F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."))))
    words = F.filter(F.split(F.regexp_replace(F.lower(path), "[0-9]+", "0"), "[^a-z0-9\\x80-\\x{10FFFF}]+"), lambda x: x != "")
    named = lambda kind, values: F.transform(values, lambda x: F.concat(F.lit(kind), x))
    return F.array_sort(F.array_distinct(F.concat(named("host=", labels), F.coalesce(ends, F.array().cast("array<string>")), named("path=", words))))


def token_items(labelled: DataFrame, least: int, total: int) -> DataFrame:
    """(token, item, n, alone, verdict, n_verdict) of the tokens of ``least`` labelled
    URLs or more: the smallest token with the same URLs, the URLs' number, whether
    it is in no longer rule that stays, and its most frequent verdict.

    A URL has few tokens, so there are at most (tokens a URL) x total / least rows.
    """
    sets = labelled.groupBy("tokens", "verdict").agg(F.count("*").alias("n"))
    # two sums of hashes of the sets name the URLs that a token occurs in
    own = [F.xxhash64(F.lit(i), "tokens", "verdict").cast("decimal(38,0)").alias(f"s{i}") for i in (0, 1)]
    found = sets.select(F.explode("tokens").alias("token"), "verdict", "n", *own).groupBy("token", "verdict").agg(*[F.sum(c).alias(c) for c in ("n", "s0", "s1")])
    every = found.groupBy("token").agg(F.max(F.struct("n", "verdict")).alias("most"), *[F.sum(c).alias(c) for c in ("n", "s0", "s1")]).where(F.col("n") >= least)
    item = F.min("token").over(Window.partitionBy("n", "s0", "s1"))
    alone = (F.col("most.n") == F.col("n")) | (F.col("n") == total)
    return staged(every.select("token", item.alias("item"), "n", alone.alias("alone"), F.col("most.verdict").alias("verdict"), F.col("most.n").alias("n_verdict")), "url-items")


def with_items(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` (tokens, ...) with ``items``, the tokens' distinct items in order, and
    ``shown``, for each item the last of the row's tokens that it stands for."""
    pairs = items.select("token", "item").toArrow()
    known = dict(zip(pairs.column(0).to_pylist(), pairs.column(1).to_pylist(), strict=True))
    shared = rows.sparkSession.sparkContext.broadcast(known)  # frequent tokens, see token_items
    names = [*rows.columns, "items", "shown"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = []
            for tokens in batch.column("tokens").to_pylist():
                own: dict[str, str] = {}
                for t in tokens:
                    if t in known:
                        own[known[t]] = max(t, own.get(known[t], t))
                found.append(sorted(own.items()))
            more = [pa.array([[pair[i] for pair in row] for row in found], pa.list_(pa.string())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema]
    return map_batches(rows, run, ", ".join([*fields, "items array<string>", "shown array<string>"]))


def mined_rules(
    labelled: DataFrame, min_support: float, min_confidence: float, max_tokens: int | None = None, items: DataFrame | None = None
) -> DataFrame:
    """(antecedent, verdict, confidence, support) from ``labelled`` (tokens, verdict).

    An antecedent lists items, each of which stands for all tokens with exactly
    the same URLs.  With ``min_support`` of s, no more than 1 / s of the item
    sets with the same number of items are disjoint, so the rules' number
    depends on the URLs' form and on s, but not on their number.
    """
    spark = labelled.sparkSession
    total = labelled.count()
    least = math.ceil(min_support * total - 1e-9)
    items = token_items(labelled, least, total) if items is None else items
    combined = with_items(labelled, items.where("NOT alone")).select(F.concat("items", F.array(F.concat(F.lit(VERDICT), "verdict"))).alias("items"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, numPartitions=parts).fit(combined)
    of = lambda kind: F.filter("items", lambda x: x.startswith(VERDICT) == F.lit(kind))
    sets = model.freqItemsets.select(F.array_sort(of(False)).alias("antecedent"), F.get(of(True), 0).alias("to"), "freq")
    sets = staged(sets.where(F.size("antecedent") > 0), "url-sets")
    judged = sets.where("to IS NOT NULL").select("antecedent", F.substring("to", len(VERDICT) + 1, 99).alias("verdict"), F.col("freq").alias("n"))
    judged = judged.join(sets.where("to IS NULL").select("antecedent", "freq"), "antecedent").select(
        "antecedent", "verdict", (F.col("n") / F.col("freq")).alias("confidence"), (F.col("n") / total).alias("support")
    )
    single = items.where((F.col("token") == F.col("item")) & F.col("alone") & (F.col("n_verdict") >= least))
    single = single.select(F.array("item").alias("antecedent"), "verdict", (F.col("n_verdict") / F.col("n")).alias("confidence"), (F.col("n_verdict") / total).alias("support"))
    judged = staged(judged.unionByName(single), "url-rules")

    # level by level, the best confidence of a rule of fewer items goes up with the sets
    longest = judged.agg(F.max(F.size("antecedent"))).first()[0] or 0
    levels = [judged.where(F.size("antecedent") == 1).withColumn("best", F.lit(0.0))]
    for size in range(2, min(longest, max_tokens or longest) + 1):
        own = judged.where(F.size("antecedent") == size)
        part = F.explode(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.filter("antecedent", lambda x, j: j != i)))
        reached = F.greatest("best", F.when(F.col("confidence") >= min_confidence, F.col("confidence")).otherwise(0.0))
        below = levels[-1].select(F.col("antecedent").alias("part"), "verdict", reached.alias("best"))
        best = own.select("antecedent", "verdict", part.alias("part")).join(below, ["part", "verdict"]).groupBy("antecedent", "verdict").agg(F.max("best").alias("best"))
        levels.append(staged(own.join(best, ["antecedent", "verdict"]), "url-rules"))
    every = reduce(DataFrame.unionByName, levels)
    return every.where((F.col("confidence") >= min_confidence) & (F.col("best") < F.col("confidence"))).drop("best")


def judged_by_rules(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(tokens, mined) of the token sets (tokens, items, shown) that a rule fits: the
    most confident rule, then the better supported, the longer, and the last in order."""
    counts = items.where(F.col("token") == F.col("item")).select("item", "n")
    rarest = rules.select("*", F.explode("antecedent").alias("item")).join(counts, "item")
    index = rarest.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("n", "item")).alias("r"))
    index = index.select(F.col("r.item").alias("item"), "antecedent", "verdict", "confidence", "support")
    hits = sets.select("tokens", "items", "shown", F.explode("items").alias("item")).join(index, "item")
    hits = hits.where(F.size(F.array_except("antecedent", "items")) == 0)
    name = F.array_sort(F.transform("antecedent", lambda x: F.element_at("shown", F.array_position("items", x).cast("int"))))
    order = F.struct("confidence", "support", F.size("antecedent").alias("size"), F.array_join(name, " ").alias("name"), "verdict")
    return hits.groupBy("tokens").agg(F.max(order).alias("mined"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    min_support: float = 0.01,
    min_confidence: float = 0.8,
    max_tokens: int | None = None,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence) of every row.

    ``rule`` is the given rule that fits, or null; then the best mined rule
    decides, or ``default`` where none fits, as for null, empty and broken URLs.
    URLs of any length are read whole.  Repeated rows are judged alike, each as a
    row; a null id stays null.  If no row is fitted by a given rule nothing is
    mined.  Rules that tie in confidence, support and length are ordered by
    their tokens.  Other columns, whatever their names, are not read.  An empty
    table gives no rows.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("given"), tokens(F.col("host"), F.col("path")).alias("tokens"))
    rows = staged(rows, "url-tokens")
    labelled = rows.where("given IS NOT NULL").select("tokens", F.col("given.verdict").alias("verdict"))
    rest = rows.where("given IS NULL")
    sets = staged(rest.groupBy("tokens").agg(F.count("*").alias("n_rows")), "url-sets")
    total = labelled.count()
    if total:
        items = token_items(labelled, math.ceil(min_support * total - 1e-9), total)
        rules_found = staged(mined_rules(labelled, min_support, min_confidence, max_tokens, items), "url-rules")
        found = judged_by_rules(with_items(sets.select("tokens"), items), rules_found, items)
    else:
        found = rows.sparkSession.createDataFrame([], "tokens array<string>, mined struct<confidence: double, support: double, size: int, name: string, verdict: string>")
    # rows that a given rule judged take no part in the join, and a common set is broadcast
    judged = staged(sets.join(found, "tokens", "left"), "url-judged")
    out = join_weighted(rest, judged, "tokens", "n_rows").unionByName(rows.where("given IS NOT NULL"), allowMissingColumns=True)
    return out.select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"), F.coalesce("given.verdict", "mined.verdict", F.lit(default)).alias("verdict"),
        F.col("mined.name").alias("mined_rule"), F.col("mined.confidence").alias("confidence"),
    )


def op3_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
