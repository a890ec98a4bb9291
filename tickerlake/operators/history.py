"""History jobs: high-water marks, incremental appends, existence guards, status.

The stored fact tables (prices, sheets) are the big inputs. Every job reduces
them to a per-key summary first -- ``max``/``distinct`` aggregate map-side, so a
symbol that holds a third of all rows contributes one row per partition to the
shuffle -- and joins that summary back. No job broadcasts on its own: the summary
size is measured at run time by AQE, which picks a broadcast join when it is
small and a shuffle join (with skew splitting) when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Status labels of one refresh per requested symbol, in the order
# the checks run, and the routing of financial sheets to their stored tables.
NOT_IN_HISTORY = "not_in_history"
NO_PRICE_HISTORY = "no_price_history"
ALREADY_LATEST = "already_latest"
COMMITTED = "committed"
UNKNOWN_REPORT = "unknown_report"

SHEET_TABLES = {
    ("is", 3): "TenQIncome",
    ("is", 12): "TenKIncome",
    ("bs", 3): "TenQBalance",
    ("bs", 12): "TenKBalance",
    ("cf", 3): "TenQCashflow",
    ("cf", 12): "TenKCashflow",
}


def latest_per_key(history: DataFrame, key: str = "Symbol", date_col: str = "Reference",
                   alias: str = "last_reference") -> DataFrame:
    """Last stored date per symbol (one partial aggregate, no sort)."""
    return history.groupBy(key).agg(F.max(date_col).alias(alias))


def _marks(history: DataFrame | None, latest: DataFrame | None, key: str, date_col: str) -> DataFrame:
    """One high-water mark per symbol: from a kept marks table (re-aggregated,
    so a symbol listed twice still joins once) or from the history itself."""
    if latest is not None:
        return latest.groupBy(key).agg(F.max("last_reference").alias("last_reference"))
    return latest_per_key(history, key, date_col)


def incremental_prices(history: DataFrame | None, incoming: DataFrame, latest: DataFrame | None = None,
                       key: str = "Symbol", date_col: str = "Reference") -> DataFrame:
    """Incoming rows strictly newer than what each symbol already has.

    Symbols without stored history are not part of the result (they are new
    listings and go through ``append_new_history``). ``latest`` may be a kept
    high-water-mark table (Symbol, last_reference); otherwise it is derived from
    ``history`` with one aggregate that reads only the two columns it needs.
    """
    marks = _marks(history, latest, key, date_col)
    joined = incoming.join(marks, key, "inner")
    return joined.where(F.col(date_col) > F.col("last_reference")).drop("last_reference")


def advance_latest(latest: DataFrame, appended: DataFrame, key: str = "Symbol",
                   date_col: str = "Reference") -> DataFrame:
    """New high-water marks after ``appended`` rows were stored."""
    fresh = appended.groupBy(key).agg(F.max(date_col).alias("last_reference"))
    return (latest.unionByName(fresh).groupBy(key)
            .agg(F.max("last_reference").alias("last_reference")))


def present_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of a (possibly huge) table; map-side combined."""
    return table.select(*keys).where(reduce(lambda a, b: a & b,
                                            [F.col(k).isNotNull() for k in keys])).distinct()


def key_exists(requested: DataFrame, table: DataFrame, keys: Sequence[str] = ("Symbol",),
               flag: str = "exists") -> DataFrame:
    """Flag each requested row: does ``table`` hold any row for its key?"""
    keys = list(keys)
    marks = present_keys(table, keys).withColumn("__hit", F.lit(True))
    return (requested.join(marks, keys, "left")
            .withColumn(flag, F.coalesce(F.col("__hit"), F.lit(False))).drop("__hit"))


def append_new_history(table: DataFrame, data: DataFrame, keys: Sequence[str] = ("Symbol",)) -> DataFrame:
    """Rows of ``data`` whose key has no row in ``table`` yet (what gets appended)."""
    keys = list(keys)
    return data.join(present_keys(table, keys), keys, "left_anti")


def rejected_history(table: DataFrame, data: DataFrame, keys: Sequence[str] = ("Symbol",)) -> DataFrame:
    """Keys of ``data`` refused because ``table`` already holds them, with row counts."""
    keys = list(keys)
    counts = data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return (counts.join(present_keys(table, keys), keys, "left_semi")
            .withColumn("status", F.lit("already_present")))


def refresh_status(requested: DataFrame, history: DataFrame | None, incoming: DataFrame,
                   latest: DataFrame | None = None, key: str = "Symbol",
                   date_col: str = "Reference") -> DataFrame:
    """One status per requested symbol for a price refresh, plus committed row count.

    Checks run in this order: no stored history -> ``not_in_history``; nothing
    fetched -> ``no_price_history``; nothing newer than the last stored date ->
    ``already_latest``; otherwise ``committed`` with the number of new rows.
    """
    marks = _marks(history, latest, key, date_col)
    per_symbol = (incoming.join(marks, key, "left")
                  .groupBy(key)
                  .agg(F.count(F.lit(1)).alias("n_incoming"),
                       F.count(F.when(F.col(date_col) > F.col("last_reference"), True)).alias("n_new")))
    req = requested.select(key).where(F.col(key).isNotNull()).distinct()
    status = (F.when(F.col("last_reference").isNull(), F.lit(NOT_IN_HISTORY))
              .when(F.coalesce(F.col("n_incoming"), F.lit(0)) == 0, F.lit(NO_PRICE_HISTORY))
              .when(F.col("n_new") == 0, F.lit(ALREADY_LATEST))
              .otherwise(F.lit(COMMITTED)))
    return (req.join(marks, key, "left").join(per_symbol, key, "left")
            .select(key, status.alias("status"),
                    F.when(status == COMMITTED, F.col("n_new")).otherwise(F.lit(0)).cast("long").alias("n_rows")))


def sheet_table_name(report_col: str = "report", freq_col: str = "freq"):
    expr = None
    for (report, freq), name in SHEET_TABLES.items():
        cond = (F.col(report_col) == report) & (F.col(freq_col) == freq)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def route_report(stored: DataFrame, rows: DataFrame,
                 keys: Sequence[str] = ("Symbol", "report", "freq")) -> DataFrame:
    """Financial-sheet rows to append, each tagged with its destination table.

    Rows with an unknown report/frequency are not routed (``route_rejects`` reports them); a
    (symbol, report, frequency) already stored is refused as a whole.
    """
    keys = list(keys)
    routed = rows.withColumn("table", sheet_table_name()).where(F.col("table").isNotNull())
    return routed.join(present_keys(stored, keys), keys, "left_anti")


def route_rejects(rows: DataFrame) -> DataFrame:
    """Reports that no stored table takes, one row per (Symbol, report, freq)."""
    bad = rows.where(sheet_table_name().isNull())
    return (bad.groupBy("Symbol", "report", "freq").agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("status", F.lit(UNKNOWN_REPORT)))
