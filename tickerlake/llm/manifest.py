"""Operator 11, a Merkle manifest of a dataset with a proof per row, by slot pivot.

Nodes of a group are numbered in order; every 8 consecutive ones have one parent.
Conditional aggregates spread a parent's children into 8 columns, one per slot:
all columns concatenated are what the parent's digest is taken of, and all but the
own slot's column are a child's siblings. Levels are built until each group has one
node; the groups' roots, in order, are the leaves of one more tree of the same kind.
Proofs go down from the root: a parent's row carries the siblings of all levels above
it, and its children read theirs off its slot columns, so one join per level is enough
and a row never meets more than its own 8 siblings.

Only built-in functions. The rows are numbered by ranges with one start each, so a
group that holds all rows is spread like any other; each level is stored (an eighth of
the one below), and the joins of a level meet on (group, parent), which at most 8 rows share.

Defined results: null values are digested as ``-``, an empty text as ``0:``; a null
group comes first; ties in the key are ordered by their digests, repeated rows are
leaves of their own; very long texts are digested whole; a null key is first in its
group and is never tampered with; a group of one row has its leaf as subroot; an
empty table gives an empty result; columns other than those digested are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake.llm.common import running_before, stored

FANOUT = 8
SLOTS = [f"c{k}" for k in range(FANOUT)]
#: The columns of a document that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts one behind the other; null parts are skipped."""
    return F.sha2(F.concat_ws("", *parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame, key: str, group: str, fields: tuple[str, ...], tampered: dict[str, Column] | None = None) -> DataFrame:
    """(key, grp, leaf, offered, row): each row's digest, and that of the row as offered for checking."""
    offered = {c: (tampered or {}).get(c, F.col(c)) for c in fields}
    return docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("grp"), digest(*[field(F.col(c)) for c in fields]).alias("leaf"),
                       digest(*[field(offered[c]) for c in fields]).alias("offered"), F.monotonically_increasing_id().alias("row"))


def _parents(nodes: DataFrame) -> DataFrame:
    """One row per parent: its children's digests by slot, its digest, and the number of nodes on its level.

    ``nodes`` holds (grp, idx, n, hash), groups of more than one node only.
    """
    slot = F.col("idx") % FANOUT
    spread = [F.max(F.when(slot == k, F.col("hash"))).alias(c) for k, c in enumerate(SLOTS)]
    up = F.floor((F.col("n") + FANOUT - 1) / F.lit(FANOUT)).cast("long")
    rows = nodes.groupBy("grp", F.floor(F.col("idx") / F.lit(FANOUT)).cast("long").alias("idx")).agg(F.max(up).alias("n"), *spread)
    return rows.withColumn("hash", digest(*[F.col(c) for c in SLOTS]))


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of parents, lowest first, and (grp, hash) of the groups' roots."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops, levels, here = nodes.where("n = 1").select("grp", "hash"), [], nodes
    while most > 1:
        here = stored(_parents(here.where("n > 1").select("grp", "idx", "n", "hash")), "manifest-level")
        levels.append(here)
        tops = tops.unionByName(here.where("n = 1").select("grp", "hash"))
        most = -(-most // FANOUT)
    return levels, tops


def _step(slot: Column) -> Column:
    """The siblings left and right of a slot among a parent's children."""
    def beside(keep) -> Column:
        return F.concat_ws("", *[F.when(keep(F.lit(k), slot), F.col(c)) for k, c in enumerate(SLOTS)])

    return F.array(F.struct(beside(lambda k, s: k < s).alias("left"), beside(lambda k, s: k > s).alias("right")))


def _with_path(nodes: DataFrame, above: DataFrame, keep: list[str]) -> DataFrame:
    """``nodes`` (grp, idx) with the path that starts at their parent's row in ``above``."""
    up = above.select(F.col("grp").alias("__g"), F.col("idx").alias("__i"), *SLOTS, F.col("path").alias("__path"), "subroot")
    mine = nodes.select(*[F.col(c).alias(f"__n_{c}") if c in SLOTS else F.col(c) for c in dict.fromkeys(["grp", "idx", *keep])])
    cond = mine["grp"].eqNullSafe(up["__g"]) & (F.floor(mine["idx"] / F.lit(FANOUT)).cast("long") == up["__i"])
    out = mine.join(up, cond).withColumn("path", F.concat(_step(F.col("idx") % FANOUT), F.col("__path")))
    return out.select(*[F.col(f"__n_{c}").alias(c) if c in SLOTS else F.col(c) for c in keep], "path", "subroot")


def _at_top(nodes: DataFrame, roots: DataFrame, keep: list[str]) -> DataFrame:
    """``nodes`` that are the roots of their groups, with the path of the group."""
    up = roots.select(F.col("grp").alias("__g"), "path", "subroot")
    return nodes.join(up, nodes["grp"].eqNullSafe(up["__g"])).select(*keep, "path", "subroot")


def _paths(nodes: DataFrame, levels: list[DataFrame], roots: DataFrame, keep: list[str]) -> DataFrame:
    """``nodes`` (grp, idx, n and ``keep``) with their whole path to the root: an array of (left, right) siblings."""
    own = ["grp", "idx", *SLOTS]
    above = None
    for level in reversed(levels):
        here = _at_top(level.where("n = 1"), roots, own)
        above = here if above is None else here.unionByName(_with_path(level.where("n > 1"), above, own))
    done = _at_top(nodes.where("n = 1"), roots, keep)
    return done if above is None else done.unionByName(_with_path(nodes.where("n > 1"), above, keep))


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to along a path."""
    return F.aggregate(path, start, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def merkle_proofs(rows: DataFrame) -> DataFrame:
    """(key, leaf, offered, subroot, root, path) for every row of ``leaves``.

    ``path`` is the proof: an array of the siblings left and right, from the leaf up to the root.
    """
    spark = rows.sparkSession
    kept = stored(rows, "manifest-leaves")
    numbered = stored(running_before(kept, ["grp"], ["key", "leaf", "row"], {"idx": None}, total="n")
                      .withColumnRenamed("leaf", "hash"), "manifest-numbered")
    levels, tops = _levels(numbered)
    tops = stored(tops.select("grp", F.col("hash"), F.lit(0).alias("all")), "manifest-tops")
    # The tree over the groups' roots: one group whose nodes are ordered by the name of theirs.
    ranked = running_before(tops, ["all"], ["grp"], {"idx": None}, total="n")
    ranked = stored(ranked.select(F.col("grp").alias("name"), F.lit(None).cast("string").alias("grp"), "idx", "n", "hash"), "manifest-ranked")
    over, whole = _levels(ranked)
    first = whole.first()
    root = first["hash"] if first else None
    start = spark.createDataFrame([(None, [], root)], "grp string, path array<struct<left:string,right:string>>, subroot string")
    roots = _paths(ranked, over, start, ["name", "hash"]).select(F.col("name").alias("grp"), "path", F.col("hash").alias("subroot"))
    out = _paths(numbered, levels, stored(roots, "manifest-roots"), ["key", "hash", "offered"])
    return out.select("key", F.col("hash").alias("leaf"), "offered", "subroot", F.lit(root).cast("string").alias("root"), "path")


def document_manifest(docs: DataFrame) -> DataFrame:
    """Proof and check of every document; where 3 divides the CRC-32 of the id, its text is offered in lower case."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    tampered = {"text": F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))}
    out = merkle_proofs(leaves(docs, "doc_id", "lang", FIELDS, tampered)).withColumn("folded_root", folded(F.col("offered"), F.col("path")))
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    return out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
