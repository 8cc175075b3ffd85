"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its pieces: lines, and sentences within lines, each
with what ends it.  A piece's hash gives ``LANES`` bits; a fingerprint is the
number of pieces and, for every lane, the number of pieces with that bit, all
modulo powers of two.  So it doesn't depend on the pieces' order, equal
multisets are equal, and pieces are inserted or deleted by adding or
subtracting their own fingerprints (``insert``, ``delete``).

Read as signs, a fingerprint's lanes are sums of independent signs over its
pieces, so their mean square estimates the squared multiplicities' sum; that
of two fingerprints' difference tells how much differs (``likeness``).

Three lanes of 20 bits and a spare bit each share a long; they are summed
together and the spare bits cleared after each step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from event_ml.llm.common import previous_in_order, staged, table

#: A piece ends after a newline or after a sentence's end and a blank.
PIECE_END = r"(?<=\n)|(?<=[.!?] )"
SHIFTS = (0, 21, 42)
ONES = sum(1 << s for s in SHIFTS)
FULL = sum(((1 << 20) - 1) << s for s in SHIFTS)
#: Two hashes of a piece, 63 bits of each.
LONGS = 2 * 21
LANES = LONGS * len(SHIFTS)
#: Where a null id sorts.
NO_ID = -(1 << 63)


def pieces(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), PIECE_END), lambda p: p != "")


def piece_hashes(parts: Column) -> Column:
    """An array of two arrays: the pieces' two hashes."""
    return F.array(F.transform(parts, lambda p: F.xxhash64(p)), F.transform(parts, lambda p: F.xxhash64(F.lit(1), p)))


def summed(hashes: Column) -> Column:
    """The fingerprint of ``piece_hashes``: the number of pieces, then ``LONGS`` longs of lanes."""
    zero = F.lit(0).cast("long")

    def lane(which: Column, j: int) -> Column:
        return F.aggregate(which, zero, lambda acc, h: (acc + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ONES))).bitwiseAND(F.lit(FULL)))

    longs = [lane(hashes[i], j) for i in range(2) for j in range(21)]
    return F.array((F.size(hashes[0]).cast("long")).bitwiseAND(F.lit((1 << 32) - 1)), *longs)


def _head(fp: Column) -> Column:
    return F.element_at(fp, 1)


def _longs(fp: Column) -> Column:
    return F.slice(fp, 2, LONGS)


def insert(a: Column, b: Column) -> Column:
    """The fingerprint of the multisets' sum."""
    rest = F.zip_with(_longs(a), _longs(b), lambda x, y: (x + y).bitwiseAND(F.lit(FULL)))
    return F.concat(F.array((_head(a) + _head(b)).bitwiseAND(F.lit((1 << 32) - 1))), rest)


def delete(a: Column, b: Column) -> Column:
    """The fingerprint of ``a``'s multiset without ``b``'s."""
    # the spare bits are set first, so no lane borrows from the next
    spare = F.lit(sum(1 << (s + 20) for s in SHIFTS))
    rest = F.zip_with(_longs(a), _longs(b), lambda x, y: (x.bitwiseOR(spare) - y).bitwiseAND(F.lit(FULL)))
    return F.concat(F.array((_head(a) - _head(b)).bitwiseAND(F.lit((1 << 32) - 1))), rest)


def mean_square(fp: Column) -> Column:
    """The mean of the lanes' squares, read as sums of signs."""
    twenty = (1 << 20) - 1

    def squares(x: Column) -> Column:
        total = F.lit(0).cast("long")
        for s in SHIFTS:
            signs = (2 * F.shiftrightunsigned(x, s).bitwiseAND(F.lit(twenty)) - _head(fp) + (1 << 19)).bitwiseAND(F.lit(twenty)) - (1 << 19)
            total = total + signs * signs
        return total

    return F.aggregate(_longs(fp), F.lit(0).cast("long"), lambda acc, x: acc + squares(x)) / float(LANES)


def likeness(a: Column, b: Column, difference: Column) -> Column:
    """1 for equal fingerprints, near 0 for texts without a common piece.

    ``difference`` is ``delete(a, b)``.  One minus the share that the squared
    multiplicities of the difference have in those of both texts; the
    estimate's standard error is about ``sqrt(2 / LANES)`` of that share.
    """
    share = mean_square(difference) / F.greatest(mean_square(a) + mean_square(b), F.lit(1e-9))
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - share)))


def text_form(fp: Column) -> Column:
    """A fingerprint as lower-case hexadecimal digits."""
    longs = F.transform(_longs(fp), lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.lower(F.concat(F.lpad(F.hex(_head(fp)), 8, "0"), F.array_join(longs, "")))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text ends with the beginning of the next document, in descending
    id order and around the end.  A null text is empty; a null id sorts as the
    smallest long.  Rows that share an id have a row each, and the one whose
    text has the smallest hash stands for the id as a next document.  Equal
    texts and ties have equal fingerprints.  A single document follows itself;
    an empty table gives an empty result.  Texts of any length are read whole.
    Other columns, whatever their names, are not read.
    """
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    sizes = rows.groupBy("key").agg(F.expr("max(length(text)) div 3").cast("int").alias("need"))
    follows = previous_in_order(rows, "key", "document-order").join(sizes, "key")
    # each document gives what the one that it follows needs of it; its id goes
    # along so that both joins read the texts in one and the same exchange
    gives = follows.select(F.col("before").alias("key"), F.col("key").alias("to"), "need")
    given = rows.join(gives, "key").select("to", F.struct(F.xxhash64("text").alias("th"), F.expr("left(text, need)").alias("start"), F.col("key").alias("next"), "doc_id").alias("g"))
    given = given.groupBy("to").agg(F.min("g").alias("g")).select(F.col("to").alias("key"), "g.start", "g.next", F.col("g.doc_id").alias("next_id"))
    cut = F.expr("floor(length(text) / 3)").cast("int")
    edited = F.concat(F.expr("left(text, length(text) - cut)"), F.expr("left(start, cut)"))
    own = rows.join(given, "key").withColumn("cut", cut).select("key", "next", "doc_id", "text", edited.alias("edited"))
    own = own.select(
        "key", "next", "doc_id", F.length("text").cast("long").alias("n_chars"), F.xxhash64("text").alias("th"), F.sha2("edited", 256).alias("edited_sha256"),
        piece_hashes(pieces(F.col("text"))).alias("h"), piece_hashes(pieces(F.col("edited"))).alias("eh"),
    )
    own = staged(own.select(*own.columns[:6], summed(F.col("h")).alias("fp"), summed(F.col("eh")).alias("efp")), "fingerprints")
    ahead = own.groupBy(F.col("key").alias("next")).agg(F.min(F.struct("th", "fp")).alias("n")).select("next", F.col("n.fp").alias("next_fp"))
    fp, efp, following = F.col("fp"), F.col("efp"), F.col("next_fp")
    compared = own.join(ahead, "next").withColumns({"de": delete(fp, efp), "dn": delete(fp, following)})
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", text_form(fp).alias("fingerprint"), text_form(efp).alias("edited_fingerprint"),
        likeness(fp, efp, F.col("de")).alias("near_edited"), likeness(fp, following, F.col("dn")).alias("near_next"),
    )


def op4_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
