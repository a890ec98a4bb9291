"""Symbol key table jobs: list comparison, new keys, ordered ticker renames.

Membership tests are semi/anti joins against the *distinct* keys of the other
side (combined map-side), never ``isin`` over collected lists. Rows with a NULL
in any column are dropped after the membership test, as the stored lists do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickerlake.operators.history import present_keys
from tickerlake.session import checkpoint_root

# Message texts of the key table jobs.
NO_NEW, ADDED = "No new records to add.", "Added %d records."
ADDED_IGNORED, RENAMED = "Added %d records and ignored %d records.", "Updated %s with %s in %s table"
# Categories of a list comparison and the stored tables a rename
# touches by default (the key table, prices, dividends and the six sheets).
OLD, NEW, REMOVED = "old", "new", "removed"
STORE_TABLES = ["AllStocksKey", "TenYrPrices", "Dividends",
                "TenKIncome", "TenKBalance", "TenKCashflow",
                "TenQIncome", "TenQBalance", "TenQCashflow"]


def compare_lists(db_list: DataFrame, new_list: DataFrame, key: str = "Symbol",
                  columns: Sequence[str] = ("Symbol", "Market")) -> DataFrame:
    """Split two key lists into old (in both), new (only in ``new_list``) and
    removed (only in ``db_list``), one DataFrame with a ``category`` column.

    Membership uses the full lists; rows with any NULL are left out. Old and new
    come from one join with a flag.
    """
    columns = list(columns)
    marks = present_keys(db_list, [key]).withColumn("__known", F.lit(True))
    seen = new_list.na.drop("any").select(*columns).join(marks, key, "left")
    current = seen.withColumn("category", F.when(F.col("__known"), F.lit(OLD)).otherwise(F.lit(NEW))).drop("__known")
    gone = db_list.na.drop("any").select(*columns).join(present_keys(new_list, [key]), key, "left_anti")
    return current.select(*columns, "category").unionByName(gone.select(*columns).withColumn("category", F.lit(REMOVED)))


def new_keys(key_table: DataFrame, candidates: DataFrame, key: str = "Symbol") -> DataFrame:
    """Candidate rows whose key is not in the key table yet (rows to append)."""
    return candidates.join(present_keys(key_table, [key]), key, "left_anti").na.drop("any")


def new_keys_summary(key_table: DataFrame, candidates: DataFrame, key: str = "Symbol") -> DataFrame:
    """One row: how many candidate rows are added and how many are ignored."""
    marks = present_keys(key_table, [key]).withColumn("__known", F.lit(True))
    tagged = candidates.join(marks, key, "left")
    kept = tagged.na.drop("any", subset=candidates.columns)
    counts = kept.agg(F.count(F.when(F.col("__known").isNull(), True)).alias("added"),
                      F.count(F.col("__known")).alias("ignored"))
    message = (F.when(F.col("added") == 0, F.lit(NO_NEW))
               .when(F.col("ignored") > 0,
                     F.format_string(ADDED_IGNORED, F.col("added"), F.col("ignored")))
               .otherwise(F.format_string(ADDED, F.col("added"))))
    return counts.withColumn("message", message)


def eligible_changes(key_table: DataFrame, changes: DataFrame, key: str = "Symbol",
                     old: str = "Old", value_cols: Sequence[str] = ("Old", "New", "Date")) -> DataFrame:
    """Ticker changes whose Old symbol is in the key table (state before any
    change) and that have no NULL in ``value_cols``."""
    known = present_keys(key_table, [key]).withColumnRenamed(key, old)
    return changes.join(known, old, "left_semi").na.drop("any", subset=list(value_cols))


def rename_map(key_table: DataFrame, changes: DataFrame, order: str = "pos",
               max_rounds: int = 64) -> DataFrame:
    """Final symbol for every symbol that some eligible change renames.

    Changes apply one after the other in ``order`` (unique per change), each to
    every row holding its Old symbol at that moment. A symbol's path therefore
    starts at the first change of that symbol and moves on to the first later
    change of the symbol it became. That successor is an as-of lookup (see
    ``_successors``: linear scans, no pairs, no unbounded group), and the end of
    each path is found by pointer doubling: ceil(log2(longest chain))
    self-joins on the unique order key, each checkpointed to cut lineage.
    Result columns: Old, New (Old != New not guaranteed: a cycle may return).
    """
    checkpoint_root(changes.sparkSession)
    E = (eligible_changes(key_table, changes)
         .select(F.col(order).alias("p"), F.col("Old").alias("o"), F.col("New").alias("n"))
         .checkpoint(eager=True))
    succ = _successors(E)
    state = E.join(succ, "p", "left").select("p", F.col("nxt").alias("ptr"), F.col("n").alias("fin"))
    state = state.checkpoint(eager=True)
    for _ in range(max_rounds):
        if state.where(F.col("ptr").isNotNull()).limit(1).count() == 0:
            break
        hop = state.select(F.col("p").alias("ptr"), F.col("ptr").alias("ptr2"), F.col("fin").alias("fin2"))
        state = (state.join(hop, "ptr", "left")
                 .select("p",
                         F.when(F.col("ptr").isNull(), F.lit(None)).otherwise(F.col("ptr2")).alias("ptr"),
                         F.when(F.col("ptr").isNull(), F.col("fin")).otherwise(F.col("fin2")).alias("fin"))
                 .checkpoint(eager=True))
    else:
        raise RuntimeError("rename chains longer than 2**max_rounds")
    first = E.groupBy("o").agg(F.min("p").alias("p"))
    return first.join(state, "p").select(F.col("o").alias("Old"), F.col("fin").alias("New"))


def _successors(E: DataFrame) -> DataFrame:
    """For each change (p, o, n): ``nxt`` = the smallest p' > p among changes
    whose Old is n (NULL when none).

    Probes (n, p) and targets (o, p') are range-partitioned together by
    (symbol, order), so a symbol holding a third of all changes spreads over
    many partitions. Inside each (symbol, partition) group a running ``last``
    in descending order finds the successor in the same partition; a probe
    with none there takes the first target of the next partitions holding that
    symbol, from a summary with one row per (symbol, partition).
    """
    ptype = E.schema["p"].dataType
    none = F.lit(None).cast(ptype)
    probes = E.select(F.col("n").alias("k"), "p", F.lit(0).alias("kind"), F.col("p").alias("src"), none.alias("tgt"))
    targets = E.select(F.col("o").alias("k"), "p", F.lit(1).alias("kind"), none.alias("src"), F.col("p").alias("tgt"))
    parts = max(int(E.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    # Ascending (symbol, order); at equal order the target sorts first, so a
    # change never counts as its own successor across a range boundary.
    ranged = (probes.unionByName(targets)
              .repartitionByRange(parts, "k", "p", F.col("kind").desc())
              .withColumn("pid", F.spark_partition_id())
              .checkpoint(eager=True))  # freeze the sampled ranges
    local = (Window.partitionBy("k", "pid").orderBy(F.col("p").desc(), F.col("kind").asc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    scanned = ranged.withColumn("nxt", F.last("tgt", ignorenulls=True).over(local)).where(F.col("kind") == 0)
    # Per (symbol, partition): the smallest target; then, over the partitions
    # after it (higher orders), the smallest of those -- the carried successor.
    firsts = ranged.where(F.col("kind") == 1).groupBy("k", "pid").agg(F.min("p").alias("first_tgt"))
    spans = ranged.select("k", "pid").distinct().join(firsts, ["k", "pid"], "left")
    later = Window.partitionBy("k").orderBy(F.col("pid").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = spans.withColumn("after", F.min("first_tgt").over(later)).select("k", "pid", "after")
    return (scanned.join(carry, ["k", "pid"], "left")
            .select(F.col("src").alias("p"), F.coalesce("nxt", "after").alias("nxt")))


def rename_keys(table: DataFrame, mapping: DataFrame, key: str = "Symbol") -> DataFrame:
    """Apply an Old -> New map to ``table``'s key column (all other rows unchanged)."""
    m = mapping.select(F.col("Old").alias("__old"), F.col("New").alias("__new"))
    joined = table.join(m, table[key] == m["__old"], "left")
    return joined.select(*[F.coalesce(F.col("__new"), F.col(key)).alias(key) if c == key else F.col(f"`{c}`")
                           for c in table.columns])


def applied_renames(key_table: DataFrame, changes: DataFrame, mapping: DataFrame, table: str,
                    before: DataFrame, after: DataFrame, key: str = "Symbol") -> DataFrame:
    """(table, message) of each eligible change that ``after`` shows to be done; ``before`` is the table as it was.

    A change is done when no row held its Old symbol, or when the symbol it finally
    becomes is there and Old is gone (or is what some other symbol became). Only
    distinct symbols are compared.
    """
    E = eligible_changes(key_table, changes).select("Old", "New").distinct()
    final = mapping.select("Old", F.col("New").alias("__final"))
    was, now = present_keys(before, [key]), present_keys(after, [key])
    image = rename_keys(was, mapping, key).distinct()

    def flag(df: DataFrame, name: str, on: str) -> DataFrame:
        return df.select(F.col(key).alias(on), F.lit(True).alias(name))

    out = (E.join(final, "Old").join(flag(was, "__held", "Old"), "Old", "left").join(flag(now, "__there", "__final"), "__final", "left")
           .join(flag(now, "__still", "Old"), "Old", "left").join(flag(image, "__image", "Old"), "Old", "left"))
    done = F.col("__held").isNull() | (F.col("__there").isNotNull() & (F.col("__still").isNull() | F.col("__image").isNotNull()))
    return out.where(done).select(F.lit(table).alias("table"), F.format_string(RENAMED, F.col("Old"), F.col("New"), F.lit(table)).alias("message"))


def renames_done(audit: DataFrame, applied: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether every expected rename message was reported (``bool_and``): one row, or one per value of ``by``.

    Columns: ``by``, n_expected and n_reported (distinct messages), all_renamed (true where none is expected).
    """
    by = list(by)
    done = audit.select(*by, "message").distinct().join(
        applied.select("message").distinct().withColumn("__done", F.lit(True)), "message", "left")
    flag = F.coalesce("__done", F.lit(False))
    return done.groupBy(*by).agg(F.count(F.lit(1)).alias("n_expected"), F.count(F.when(flag, True)).alias("n_reported"),
                                 F.coalesce(F.bool_and(flag), F.lit(True)).alias("all_renamed"))


def rename_audit(key_table: DataFrame, changes: DataFrame, tables: Sequence[str] = tuple(STORE_TABLES)) -> DataFrame:
    """One message per (table, eligible change), as the sequential updates report them."""
    names = F.array(*[F.lit(t) for t in tables])
    E = eligible_changes(key_table, changes)
    return (E.select("Old", "New", F.explode(names).alias("table"))
            .withColumn("message", F.format_string(RENAMED,
                                                   F.col("Old"), F.col("New"), F.col("table"))))
