"""Merkle manifest of a document table, and a proof for every document.

Each row is a leaf, the digest of its columns.  A source's leaves, ordered by
id, form a tree in which every run of ``FAN_OUT`` nodes has a parent, the
digest of their digests; the sources' roots form one tree in the same way.

* The levels are built one after the other and stored as parent-linked node
  rows: a node, the digests below it, and where it stands below its parent.
* A recursive query (``WITH RECURSIVE``) climbs from every leaf.  A step joins
  the parent's row, appends the other digests below it to the proof, puts the
  climber's own digest in its place and digests the result.  The leaf that
  starts the climb may have been tampered with; the siblings are the stored
  ones, so its climb ends at another root.
* The leaves of one run climb in one row, each with a digest of its own: they
  share all siblings above their own level, which are appended once.
* All climbers of a tree pass its upper nodes.  A node's row is therefore
  stored once for each block of ``FAN_OUT ** 3`` leaves below it, and a join
  key never holds more climbers than one block has.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.functions.joins import join_small
from event_ml.functions.prefix import ordered_prefix
from event_ml.llm.common import staged, table

FAN_OUT = 16
#: Levels of a block: it has FAN_OUT ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 3
HEX = 64
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Manifest(NamedTuple):
    """``runs`` (tree, run, n, members), ``nodes`` (tree, block, top, level, idx,
    children, next_top, next_level, next_idx, next_pos), ``trees`` (tree, n, subroot)
    and the root's digest (None for an empty table)."""

    runs: DataFrame
    nodes: DataFrame
    trees: DataFrame
    root: str | None


def digest(values: Sequence[Column]) -> Column:
    """Hex sha256 of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, columns: Sequence[str] = COLUMNS, every: int = 5) -> DataFrame:
    """(doc_id, src, leaf, tampered, row): ``tampered`` is the leaf of the row whose
    text lost its capitals A-Z, null where ``every`` doesn't divide the id's crc32."""
    id_col, source, *_, text = columns
    own = [F.col(c) for c in columns]
    hit = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    lowered = digest([*own[:-1], F.translate(F.col(text).cast("string"), UPPER, LOWER)])
    # the null source comes first, others in the order of their bytes
    src = F.coalesce(F.concat(F.lit("1"), F.col(source).cast("string")), F.lit("0"))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), src.alias("src"), digest(own).alias("leaf"), F.when(hit, lowered).alias("tampered")).withColumn(
        "row", F.monotonically_increasing_id()
    )


def _parents(level: DataFrame, label: str) -> DataFrame:
    """(tree, idx, size, hash, children) of the next level; trees that have one node stop."""
    group = F.floor(F.col("idx") / FAN_OUT).alias("idx")
    size = F.ceil(F.col("size") / FAN_OUT).alias("size")
    run = level.where("size > 1").groupBy("tree", group, size).agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("i"), "hash"))).alias("run"))
    children = F.array_join("run.hash", "")
    return staged(run.select("tree", "idx", "size", F.sha2(children, 256).alias("hash"), children.alias("children")), label)


def _levels(n: int) -> int:
    """Levels above the leaves of a tree of ``n``."""
    count = 0
    while n > 1:
        n, count = -(-n // FAN_OUT), count + 1
    return count


def _linked(rows: DataFrame, top: bool, level: int, several: bool) -> DataFrame:
    """Node rows with the place of each below its parent: in its own tree, or the
    top tree's first level for a source's root, or nowhere for the root of all."""
    inside = F.col("size") > 1
    above = F.lit(several and not top)
    own = F.col("idx") if top else F.col("tree")
    return rows.select(
        "tree", "block", F.lit(top).alias("top"), F.lit(level).alias("level"), "idx", "children",
        F.when(inside, F.lit(top)).when(above, F.lit(True)).alias("next_top"),
        F.when(inside, F.lit(level + 1)).when(above, F.lit(1)).alias("next_level"),
        F.when(inside, F.floor(F.col("idx") / FAN_OUT)).when(above, F.floor(own / FAN_OUT)).alias("next_idx"),
        F.when(inside, F.col("idx") % FAN_OUT).when(above, own % FAN_OUT).cast("int").alias("next_pos"),
    )


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, every: int = 5) -> Manifest:
    """The manifest of ``docs``; leaves with equal ids are ordered by their digests."""
    rows = staged(leaves(docs, columns, every), "merkle-leaves")
    sizes = staged(rows.groupBy("src").agg(F.count("*").alias("n")), "merkle-sources")
    n_trees, largest = sizes.agg(F.count("*"), F.max("n")).first()
    ranked = ordered_prefix(sizes.withColumn("one", F.lit(1)), "src", ["one"])
    trees = staged(ranked.select("src", (F.col("one_cum") - 1).alias("tree"), "n"), "merkle-trees")
    ordered = ordered_prefix(rows.withColumn("one", F.lit(1)), ["doc_id", "leaf", "row"], ["one"], partition_cols=["src"])
    placed = join_small(ordered.withColumn("idx", F.col("one_cum") - 1), trees, "src")
    member = F.struct((F.col("idx") % FAN_OUT).cast("int").alias("pos"), "doc_id", "leaf", "tampered")
    runs = placed.groupBy("tree", "n", F.floor(F.col("idx") / FAN_OUT).alias("run")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    runs = staged(runs, "merkle-runs")

    blocks = runs.where(F.col("run") % FAN_OUT ** (BLOCK_LEVELS - 1) == 0)
    blocks = staged(blocks.select("tree", F.floor(F.col("run") / FAN_OUT ** (BLOCK_LEVELS - 1)).alias("block")), "merkle-blocks")
    several = n_trees > 1
    family = F.array_join("members.leaf", "")
    first = runs.where("n > 1").select("tree", F.col("run").alias("idx"), F.ceil(F.col("n") / FAN_OUT).alias("size"), F.sha2(family, 256).alias("hash"), family.alias("children"))
    roots = [runs.where("n = 1").select("tree", F.col("members")[0]["leaf"].alias("subroot"))]
    nodes = []
    now = staged(first, "merkle-level")
    for level in range(1, _levels(largest or 0) + 1):
        if level > 1:
            now = _parents(now, "merkle-level")
            if level <= BLOCK_LEVELS:
                below = now.withColumn("block", F.floor(F.col("idx") / FAN_OUT ** (BLOCK_LEVELS - level)))
            else:
                # few nodes where many blocks share one: Spark broadcasts by the files' size
                over = blocks.withColumn("idx", F.floor(F.col("block") / FAN_OUT ** (level - BLOCK_LEVELS)))
                below = over.join(now, ["tree", "idx"])
            nodes.append(_linked(below, False, level, several))
        roots.append(now.where("size = 1").select("tree", F.col("hash").alias("subroot")))
    trees = trees.drop("src").join(reduce(DataFrame.unionByName, roots), "tree")
    trees = staged(trees, "merkle-subroots")

    root = trees.select("subroot").first()[0] if n_trees == 1 else None
    top = trees.select(F.lit(-1).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_trees).alias("size"), F.col("subroot").alias("hash"))
    for level in range(1, _levels(n_trees) + 1):
        top = _parents(top, "merkle-level")
        over = blocks.withColumn("idx", F.floor(F.col("tree") / FAN_OUT**level))
        nodes.append(_linked(over.join(top.drop("tree"), "idx"), True, level, several))
        if level == _levels(n_trees):
            root = top.first()["hash"]
    if not nodes:
        nodes = [_linked(now.withColumn("block", F.col("idx")), False, 1, several).limit(0)]
    return Manifest(runs, staged(reduce(DataFrame.unionByName, nodes), "merkle-nodes"), trees, root)


@contextlib.contextmanager
def _many_rows(spark: SparkSession) -> Iterator[None]:
    """A recursive query may have any number of rows while this lasts."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


CLIMB = f"""
WITH RECURSIVE climb(tree, run, block, top, level, idx, pos, folds, proof) AS (
  SELECT tree, run, block, top, level, idx, pos, folds, proof FROM {{start}}
  UNION ALL
  SELECT c.tree, c.run, c.block, n.next_top, n.next_level, n.next_idx, n.next_pos,
         transform(c.folds, f -> unhex(sha2(concat(
           substring(n.children, 1, {HEX} * c.pos), lower(hex(f)), substring(n.children, {HEX} * c.pos + {HEX + 1})), 256))),
         concat(c.proof, unhex(concat(substring(n.children, 1, {HEX} * c.pos), substring(n.children, {HEX} * c.pos + {HEX + 1}))))
  FROM climb c JOIN {{nodes}} n
    ON c.tree = n.tree AND c.block = n.block AND c.top = n.top AND c.level = n.level AND c.idx = n.idx
)
SELECT tree, run, folds, proof FROM climb WHERE level IS NULL
"""


def _around(digests: Column, pos: Column) -> Column:
    """The digests other than the one at ``pos``."""
    return F.concat(digests.substr(F.lit(1), HEX * pos), digests.substr(HEX * pos + HEX + 1, F.length(digests)))


def climb(manifest: Manifest) -> DataFrame:
    """(tree, run, folds, proof): where each leaf of a run ends, and the digests it
    met above its own run, as bytes."""
    runs = manifest.runs
    several = manifest.trees.count() > 1
    family = F.array_join("members.leaf", "")

    def folded(m: Column) -> Column:
        own = F.coalesce(m["tampered"], m["leaf"])
        met = F.concat(family.substr(F.lit(1), HEX * m["pos"]), own, family.substr(HEX * m["pos"] + HEX + 1, F.length(family)))
        return F.unhex(F.when(F.col("n") > 1, F.sha2(met, 256)).otherwise(own))

    inside = F.col("n") > FAN_OUT
    above = F.lit(several)
    start = runs.select(
        "tree", "run", F.floor(F.col("run") / FAN_OUT ** (BLOCK_LEVELS - 1)).alias("block"),
        F.when(inside, F.lit(False)).when(above, F.lit(True)).alias("top"),
        F.when(inside, F.lit(2)).when(above, F.lit(1)).alias("level"),
        F.when(inside, F.floor(F.col("run") / FAN_OUT)).when(above, F.floor(F.col("tree") / FAN_OUT)).alias("idx"),
        F.when(inside, F.col("run") % FAN_OUT).when(above, F.col("tree") % FAN_OUT).cast("int").alias("pos"),
        F.transform("members", folded).alias("folds"),
        F.unhex(F.lit("")).alias("proof"),
    )
    spark = runs.sparkSession
    with _many_rows(spark):
        return staged(spark.sql(CLIMB, start=start, nodes=manifest.nodes), "merkle-climb")


def prove(docs: DataFrame, columns: Sequence[str] = COLUMNS, every: int = 5) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``columns`` are the id, the source, further columns, and the text; others,
    whatever their names, are not read.  Nulls of any column have digests of
    their own; rows without an id come first in their source and aren't tampered
    with; a null source is a source.  An empty text is no null.  Texts are
    digested whole, whatever their length.  Repeated rows are leaves of their
    own, next to each other; rows that share an id are ordered by their
    digests.  An empty table gives no rows.
    """
    if docs.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    manifest = build(docs, columns, every)
    ended = climb(manifest)
    rows = join_small(manifest.runs.join(ended, ["tree", "run"]), manifest.trees.select("tree", "subroot"), "tree")
    rows = rows.select("subroot", "folds", "proof", F.array_join("members.leaf", "").alias("family"), F.explode("members").alias("m"))
    rows = rows.select(
        "m.*", "subroot", F.lower(F.hex(F.get("folds", F.col("m.pos")))).alias("folded_root"),
        F.sha2(F.concat(_around(F.col("family"), F.col("m.pos")), F.lower(F.hex("proof"))), 256).alias("proof_sha256"),
    )
    return rows.select(
        "doc_id", "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == manifest.root).alias("verified")
    )


def op11_merkle_climb(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prove(table(spark, sf_dir, "documents"))


def _sql_parts(text: str) -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in ("d.doc_id", "d.source", "d.lang", "d.n_chars", text)]
    return f"sha256({' || '.join(parts)})"


OP11_SQL = f"""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
leaf AS (
  SELECT d.doc_id, d.source, {_sql_parts('d.text')} AS leaf,
         CASE WHEN crc % 5 = 0 THEN {_sql_parts(f"translate(d.text, '{UPPER}', '{LOWER}')")} ELSE {_sql_parts('d.text')} END AS now,
         row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id NULLS FIRST) - 1 AS idx,
         count(*) OVER (PARTITION BY d.source) AS n,
         dense_rank() OVER (ORDER BY d.source NULLS FIRST) - 1 AS tree
  FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id),
up AS (
  SELECT tree, 0 AS lvl, idx, n, leaf AS h FROM leaf
  UNION ALL
  SELECT tree, lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, lvl, idx // 16, n),
tops AS (
  SELECT 0 AS lvl, tree AS idx, (SELECT count(DISTINCT tree) FROM leaf) AS n, h FROM up WHERE n = 1
  UNION ALL
  SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 16, n),
node AS (
  SELECT tree, false AS top, lvl, idx, n, h FROM up UNION ALL SELECT -1, true, lvl, idx, n, h FROM tops),
family AS (
  SELECT tree, top, lvl + 1 AS lvl, idx // 16 AS idx, (n + 15) // 16 AS size, list(h ORDER BY idx) AS hs FROM node WHERE n > 1 GROUP BY ALL),
climb AS (
  SELECT doc_id, tree AS own, leaf, idx AS leaf_idx, tree, false AS top, 0 AS lvl, idx, n, now AS h, '' AS proof FROM leaf
  UNION ALL
  SELECT c.doc_id, c.own, c.leaf, c.leaf_idx, f.tree, f.top, f.lvl, f.idx, f.size,
         sha256(array_to_string(list_concat(list_slice(f.hs, 1, slot), [c.h], list_slice(f.hs, slot + 2, 16)), '')),
         c.proof || array_to_string(list_concat(list_slice(f.hs, 1, slot), list_slice(f.hs, slot + 2, 16)), '')
  FROM (SELECT *, CASE WHEN n > 1 OR top THEN idx ELSE own END % 16 AS slot, CASE WHEN n > 1 OR top THEN idx ELSE own END // 16 AS to_idx,
               CASE WHEN n > 1 THEN lvl + 1 ELSE 1 END AS to_lvl, CASE WHEN n > 1 THEN tree ELSE -1 END AS to_tree FROM climb WHERE n > 1 OR NOT top) c
  JOIN family f ON f.tree = c.to_tree AND f.lvl = c.to_lvl AND f.idx = c.to_idx),
done AS (SELECT *, row_number() OVER (PARTITION BY own, leaf_idx ORDER BY top DESC, lvl DESC) AS last FROM climb)
SELECT d.doc_id, d.leaf, u.h AS subroot, t.h AS root, sha256(d.proof) AS proof_sha256, d.h AS folded_root, d.h = t.h AS verified
FROM done d JOIN up u ON u.tree = d.own AND u.n = 1 CROSS JOIN (SELECT h FROM tops WHERE n = 1) t WHERE d.last = 1
"""
