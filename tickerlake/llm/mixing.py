"""Operator 3, mixing sources to target weights: Efraimidis-Spirakis sampling, native Spark only.

Each document draws the exponential key -ln(u) / quality, where u comes from its
id (reruns agree). Within a source, ascending keys are a weighted sample without
replacement. A source's budget of words is spent in complete epochs first
(every document once per epoch); the rest goes down the key order by prefix sum.
The last document reached is cut to the words that remain, so every source meets
its target to within one word per tied row.

The prefix sum never sorts a whole source in one task: sizes are summed per
(source, key bucket), the bucket that holds the budget's end is found from those
sums, and only that bucket's rows are summed one by one: at most some 3 / 65,536 of a
source's documents, whatever their qualities (``key_bucket``).

Defined results: null text has size 0 and takes 0; a null source is a source of
its own and comes last; rows with the same id and text are tied, and a tie at the
budget's end shares the words that remain evenly; an empty table gives an empty
result; extra columns do not matter, ``mix`` reads three columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: The weights that sources get in turn, and the most epochs of any source.
TURN_WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
#: Key buckets per source.
BUCKETS = 1 << 16
SYMBOLS = "#*$%&|<>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, words: Column) -> Column:
    """Between 1/3 and 1: less for texts with many markup symbols per word."""
    body = F.coalesce(text, F.lit(""))
    symbols = F.length(body) - F.length(F.translate(body, SYMBOLS, ""))
    return (1.0 + words) / (1.0 + words + 2.0 * F.least(symbols, words))


def uniform(key: Column, seed: int) -> Column:
    """In (0, 1), from the id alone: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") + 0.5) / F.lit(float(1 << 52))


def key_bucket(key: Column) -> Column:
    """Number of the key's bucket: the mean of the keys' distributions at qualities 1, 2/3 and 1/3, cut evenly.

    A quality q has keys of distribution 1 - exp(-q key); against this mean no quality
    between 1/3 and 1 has more than three times an even share in any bucket.
    """
    e = F.exp(-key / 3.0)
    return F.least(F.floor((1 - (e + e * e + e * e * e) / 3.0) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def keyed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` with __size, __key, __tie and __bucket (which grows with the key)."""
    docs = docs.withColumn("__size", n_words(F.col("text")))
    docs = docs.withColumn("__key", -F.log(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"), F.col("__size")))
    tie = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    return docs.withColumn("__tie", tie).withColumn("__bucket", key_bucket(F.col("__key")))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size) -> with ``target``: the total shared by weight, capped at 3 x the source's size.

    The excess is reshared by weight until none is above its cap. With sources in
    the order of cap / weight, the capped ones are a prefix of that order, so the
    fixed point follows from running sums. One row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in TURN_WEIGHTS]), (F.pmod(turn, F.lit(len(TURN_WEIGHTS))) + 1).cast("int"))
    t = sizes.withColumn("__w", w).withColumn("__cap", MOST_EPOCHS * F.col("source_size").cast("double"))
    by = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").isNull(), F.col("source"))
    t = t.withColumn("__caps", F.coalesce(F.sum("__cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    t = t.withColumn("__rest", F.sum("__w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    everything = Window.partitionBy()
    t = t.withColumn("__total", F.sum(F.col("source_size").cast("double")).over(everything))
    # The first source in this order that stays below its cap sets the level; later ones give lower values.
    level = (F.col("__total") - F.col("__caps")) / F.col("__rest")
    t = t.withColumn("__level", F.when(level * F.col("__w") <= F.col("__cap"), level))
    t = t.withColumn("__level", F.max("__level").over(everything))
    share = F.least(F.col("__cap"), F.coalesce(F.col("__level") * F.col("__w"), F.col("__cap")))
    return t.select("source", "source_size", share.alias("target"))


def plan(rows: DataFrame) -> DataFrame:
    """One row per source: target, whole epochs, and the key, tie and words at which the budget ends."""
    hist = rows.groupBy("source", "__bucket").agg(F.sum("__size").alias("__words"))
    sizes = hist.groupBy("source").agg(F.sum("__words").alias("source_size"))
    t = targets(sizes)
    t = t.withColumn("epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(MOST_EPOCHS))).otherwise(0).cast("long"))
    t = t.withColumn("__left", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    upto = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("__before", F.coalesce(F.sum("__words").over(upto), F.lit(0)))
    t2 = t.withColumnRenamed("source", "__s")
    edge = hist.join(t2, F.col("source").eqNullSafe(F.col("__s"))).filter(
        (F.col("__before") < F.col("__left")) & (F.col("__left") <= F.col("__before") + F.col("__words")))
    edge = edge.select(F.col("__s"), F.col("__bucket").alias("__b"), "__before", "__left")
    at = rows.join(edge, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    ties = at.groupBy("source", "__key", "__tie", "__before", "__left").agg(
        F.sum("__size").alias("__words"), F.count(F.lit(1)).alias("__rows"))
    upto = Window.partitionBy("source").orderBy("__key", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    ties = ties.withColumn("__reached", F.col("__before") + F.coalesce(F.sum("__words").over(upto), F.lit(0)))
    ends = ties.filter((F.col("__reached") < F.col("__left")) & (F.col("__left") <= F.col("__reached") + F.col("__words")))
    ends = ends.select(F.col("source").alias("__s"), F.col("__key").alias("cut_key"), F.col("__tie").alias("cut_tie"),
                       F.floor((F.col("__left") - F.col("__reached")) / F.col("__rows")).cast("long").alias("cut_words"))
    return t.join(ends, F.col("source").eqNullSafe(F.col("__s")), "left").select(
        F.col("source").alias("__source"), "source_size", "target", "epochs", "cut_key", "cut_tie", "cut_words")


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with source_size, target, epochs, part and taken.

    ``epochs`` whole copies and then the first ``part`` words are taken;
    ``taken`` = epochs x size + part, at most 3 x size.
    """
    rows = keyed(docs.select("doc_id", "text", "source"), seed).drop("text")
    rows = stored(rows, "mix-keys")
    return decide(rows, plan(rows)).select("doc_id", F.col("__size").alias("size"), "source", "source_size", "target",
                                           "epochs", "part", "taken")


def decide(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """Keyed rows with their source's plan and their own ``part`` and ``taken``."""
    out = rows.join(ends, F.col("source").eqNullSafe(F.col("__source")), "left")
    here = F.struct("__key", "__tie")
    cut = F.struct(F.col("cut_key").alias("__key"), F.col("cut_tie").alias("__tie"))
    part = F.when(F.col("cut_key").isNull(), 0).when(here < cut, F.col("__size")).when(here == cut, F.col("cut_words")).otherwise(0)
    out = out.withColumn("part", part.cast("long"))
    return out.withColumn("taken", (F.col("epochs") * F.col("__size") + F.col("part")).cast("long"))


def mixed_documents(docs: DataFrame, seed: int = 0, cut_last: bool = True) -> DataFrame:
    """The mixed corpus itself: rows of ``docs`` (all its columns), repeated per epoch.

    A document's whole copies come as that many equal rows. With ``cut_last`` the part of the
    last document is a row whose text ends with its last taken word; without, that
    document comes whole if at least half of its words are due, so that texts stay as
    they are and a source meets its target to within half a document per tied row.
    Documents that take no word, those without words among them, give no row.
    """
    columns = docs.columns
    whole = F.struct(*[F.col(f"`{c}`") for c in columns])  # one column, so that no name of the input can clash
    rows = keyed(docs.select("doc_id", "text", "source", whole.alias("__row")), seed)
    ends = stored(plan(stored(rows.select("source", "__size", "__key", "__tie", "__bucket"), "mix-keys")), "mix-plan")
    out = decide(rows, ends)
    if not cut_last:
        due = F.when(2 * F.col("part") >= F.col("__size"), F.col("__size")).otherwise(0).cast("long")
        out = out.withColumn("part", due).withColumn("taken", F.col("epochs") * F.col("__size") + F.col("part"))
    out = out.filter(F.col("taken") > 0)
    times = F.col("epochs") + (F.col("part") == F.col("__size")).cast("long")
    copies = F.array_repeat(F.lit(-1).cast("long"), times.cast("int"))
    if not cut_last:
        return out.withColumn("__take", F.explode(copies)).select(*[F.col("__row")[c].alias(c) for c in columns])
    cut = F.when((F.col("part") > 0) & (F.col("part") < F.col("__size")), F.array("part")).otherwise(F.array().cast("array<long>"))
    out = out.withColumn("__take", F.explode(F.concat(copies, cut)))
    pieces = F.regexp_extract_all(F.col("text"), F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    head = F.array_join(F.slice(pieces, 1, F.col("__take").cast("int")), "")
    text = F.when(F.col("__take") < 0, F.col("text")).otherwise(head)
    return out.select(*[(text if c == "text" else F.col("__row")[c]).alias(c) for c in columns])
