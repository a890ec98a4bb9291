"""Operator 4, document fingerprints: one-permutation MinHash, native Spark only.

Every word shingle is hashed once. The top bits choose one of 256 bins, whose
minimum is kept. An empty bin copies another by optimal densification: it
follows its own fixed random order of bins to the first that is not empty.
Of each bin 8 low-order bits are stored (mixed with the bin's number, so that
copied bins disagree independently), as 512 hex digits. The likeness of two
fingerprints is the share of equal bins, corrected for 8-bit chance agreement.

Defined results: a null or empty text has no shingles and the fingerprint '',
like '' with 1 and anything else with 0; a text of fewer than five words is one
shingle; equal texts have equal fingerprints; of several rows with one id, the
one with the smallest text stands for that id as 'next document', and a table
with one id is its own next; a null id comes last; only id and text are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import ROWS_PER_RANK_PART, stored, texts

BINS, BITS, SHINGLE, PROBES = 256, 8, 5, 16
SEPARATORS = r"[\x20\x09-\x0D]+"
_SHIFT = 64 - BINS.bit_length() + 1
_LOW = (1 << _SHIFT) - 1


def _empty(x: Column) -> Column:
    """The filler of a bin without a shingle is the bin's largest value."""
    return x.bitwiseAND(F.lit(_LOW)) == F.lit(_LOW)


def with_codes(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint codes (array of 256 signed bytes; null without shingles) of column ``text``.

    Each intermediate array is a column of its own, so that Spark computes it once.
    """
    keep = [c for c in df.columns]
    words = F.filter(F.split(F.col(text), SEPARATORS), lambda w: w != "")
    df = df.withColumn("__w", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("__w")
    at = lambda i: [F.get(F.col("__w"), i + j) for j in range(SHINGLE)]
    shingles = (F.when(n >= SHINGLE, F.transform(F.sequence(F.lit(0), n - SHINGLE), lambda i: F.xxhash64(*at(i))))
                .when(n > 0, F.array(F.xxhash64(F.col("__w")))))
    step = F.lit(1 << _SHIFT)
    filler = F.concat(F.sequence(F.lit(_LOW - (1 << 63)), F.lit(-1), step), F.sequence(F.lit(_LOW), F.lit((1 << 63) - 1), step))
    df = df.select(*keep, F.sort_array(F.concat(shingles, filler)).alias("__s"))
    top = lambda x: F.shiftrightunsigned(x, _SHIFT)
    first = lambda x, i: (i == 0) | (top(x) != top(F.get(F.col("__s"), i - 1)))
    # Signed order: the bins from 128 up come first; rotate so that entry b is bin b.
    mins = F.filter(F.col("__s"), first)
    df = df.select(*keep, mins.alias("__m"))
    half = BINS // 2
    df = df.select(*keep, F.concat(F.slice("__m", half + 1, half), F.slice("__m", 1, half)).alias("__b"))
    df = df.withColumn("__full", F.filter(F.col("__b"), lambda x: ~_empty(x)))
    tries = F.sequence(F.lit(1), F.lit(PROBES))

    def fill(x: Column, b: Column) -> Column:
        probe = lambda j: F.get(F.col("__b"), F.pmod(F.xxhash64(b, j), F.lit(BINS)).cast("int"))
        tried = F.filter(F.transform(tries, probe), lambda y: ~_empty(y))
        rest = F.array_min(F.transform(F.col("__full"), lambda y: F.struct(F.xxhash64(b, top(y)).alias("h"), y.alias("y"))))["y"]
        value = F.when(~_empty(x), x).otherwise(F.coalesce(F.get(tried, F.lit(0)), rest))
        return (F.xxhash64(value, b).bitwiseAND(F.lit((1 << BITS) - 1)) - (1 << (BITS - 1))).cast("byte")

    return df.select(*keep, F.transform(F.col("__b"), fill).alias(out))


def as_text(codes: Column) -> Column:
    digits = F.split(F.lit(" ".join(f"{c:02x}" for c in range(1 << BITS))), " ")  # one constant
    return F.coalesce(F.array_join(F.transform(codes, lambda c: F.get(digits, c.cast("int") + (1 << (BITS - 1)))), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1, from two code arrays."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)) / F.lit(float(BINS))
    chance = 1.0 / (1 << BITS)
    both = F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0)
    return F.coalesce(both, F.greatest(F.lit(0.0), (same - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each row's text as a string column."""
    codes = with_codes(docs.withColumn("__text", F.coalesce(F.col(text), F.lit(""))), "__text", "__codes")
    return codes.withColumn(out, as_text(F.col("__codes"))).drop("__text", "__codes")


def successors(docs: DataFrame) -> DataFrame:
    """(doc_id, before, n_before): the id whose next document ``doc_id`` is, in descending order, and its length.

    Neighbours are found inside range partitions of the ids; a summary row per
    partition carries them over the partitions' edges. The range partitions are
    stored before they are used twice.
    """
    ids = docs.groupBy("doc_id").agg(F.max(F.length("text")).alias("n"))
    ids = stored(ids, "fp-ids")
    parts = max(1, math.ceil(ids.count() / ROWS_PER_RANK_PART))
    order = F.col("doc_id").desc_nulls_last()
    ranged = ids.repartitionByRange(parts, order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "fp-ranges")
    me = F.struct("doc_id", "n")
    last = ranged.groupBy("part").agg(F.max_by(me, F.struct(F.col("doc_id").isNull(), -F.col("doc_id"))).alias("last"))
    every = Window.orderBy("part")
    edges = last.withColumn("edge", F.coalesce(F.lag("last").over(every), F.last("last").over(
        every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    edges = edges.select(F.col("part").alias("p"), "edge")
    inside = ranged.withColumn("prev", F.lag(me).over(Window.partitionBy("part").orderBy(order)))
    out = inside.join(edges, F.col("part") == F.col("p")).withColumn("prev", F.coalesce("prev", "edge"))
    return out.select("doc_id", F.col("prev.doc_id").alias("before"), F.col("prev.n").alias("n_before"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likenesses.

    The edited text is the first half and then as many first code points of the
    next document. The texts are shuffled once by id (both sides of the join
    read that one exchange); only the heads travel on to their neighbour.
    """
    rows = with_codes(texts(docs), "text", "codes")
    ptr = successors(texts(docs)).select(F.col("doc_id").alias("__id"), "before", "n_before")
    heads = rows.join(ptr, F.col("doc_id").eqNullSafe(F.col("__id")))
    head = F.substring(F.col("text"), F.lit(1), F.floor(F.col("n_before") / 2).cast("int"))
    heads = heads.select("before", F.struct(head.alias("head"), F.col("codes")).alias("next"))
    heads = heads.groupBy("before").agg(F.min("next").alias("next"))
    out = rows.join(heads, F.col("doc_id").eqNullSafe(F.col("before")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.head"), F.lit(1), half))
    out = out.select("doc_id", n.cast("long").alias("n_chars"), "codes", F.col("next.codes").alias("next_codes"), edited.alias("edited"))
    out = with_codes(out, "edited", "edited_codes")
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), as_text(F.col("codes")).alias("fingerprint"),
        as_text(F.col("edited_codes")).alias("edited_fingerprint"), likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"))
