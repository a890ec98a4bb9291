"""Financial sheets (10-K / 10-Q income, balance, cash flow) in long form.

Stored as one long table ``(Symbol, report, freq, pos, item, label, period,
value)`` instead of one wide table per company layout: every company may use
its own fiscal periods, and the long form needs no schema change per file. The
wide report is a ``pivot`` over the periods that hold a value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.functions import exprs as X

SHEET_KEYS = ["Symbol", "report", "freq"]
PERIOD_KEYS = ["Symbol", "report", "freq", "period"]

# Report codes, the item-column title each one gets, and the text
# the first header cell of every sheet must contain.
REPORT_CODES = ("is", "bs", "cf")
ITEM_TITLES = {"is": "Income item", "bs": "Balance item", "cf": "Cashflow item"}
FISCAL_MARK = "Fiscal"


def drop_null_periods(long: DataFrame, keys: Sequence[str] = tuple(PERIOD_KEYS)) -> DataFrame:
    """Remove periods that are NULL for every item of a sheet.

    Equivalent to dropping each sheet's all-NULL columns before sheets are
    stacked. One window over one column of one report: a single scan and shuffle.
    """
    alive = F.count("value").over(Window.partitionBy(*keys))
    return long.withColumn("__alive", alive).where(F.col("__alive") > 0).drop("__alive")


def bad_sheets(long: DataFrame) -> DataFrame:
    """Sheets whose first header cell lacks the fiscal-year marker."""
    return (long.where(~F.coalesce(F.col("label").contains(FISCAL_MARK), F.lit(False)))
            .select(*SHEET_KEYS, "label").distinct())


def _checked(long: DataFrame) -> DataFrame:
    """The rows themselves, raising (when they are read) on a header without the fiscal-year marker."""
    if "label" not in long.columns:
        return long
    good = F.coalesce(F.col("label").contains(FISCAL_MARK), F.lit(False))
    message = F.format_string(f"sheet header without '{FISCAL_MARK}' in its first cell: %s/%s/%s",
                              F.col("Symbol"), F.col("report"), F.col("freq").cast("string"))
    return long.withColumn("item", F.when(good, F.col("item")).otherwise(F.raise_error(message)))


def period_names(long: DataFrame) -> list[str]:
    """Period names in order, empty periods included: one aggregate, at most ``spark.sql.pivotMaxValues`` names."""
    most = int(long.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = long.select("period").distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} periods (spark.sql.pivotMaxValues)")
    return sorted(r.period for r in found if r.period is not None)


def live_periods(long: DataFrame) -> list[str]:
    """Names of the periods that hold a value, in order."""
    return period_names(long.where(F.col("value").isNotNull()))


def format_sheet(long: DataFrame, report: str, periods: Sequence[str] | None = None, freq: int | None = None,
                 strict: bool = True) -> DataFrame:
    """Wide report: one row per (Symbol, item position), one column per period that holds a value.

    The item column is titled after the report ('Cashflow item' ...), spaces in
    names become underscores and Symbol comes first. Periods that are NULL
    throughout are dropped and all others kept; ``periods`` names the columns
    instead, and saves the scan that finds them. ``pos`` keeps repeated item
    names apart (a section title may repeat); two cells of one item and period are an error.
    """
    if report not in REPORT_CODES:
        raise ValueError(f"unknown report {report!r}; expected one of {REPORT_CODES}")
    rows = long.where(F.col("report") == report)
    if freq is not None:
        rows = rows.where(F.col("freq") == freq)
    if periods is None:
        periods = live_periods(rows)
    if strict:
        rows = _checked(rows)
    else:
        rows = rows.join(bad_sheets(rows).select(*SHEET_KEYS), SHEET_KEYS, "left_anti")
    twice = F.raise_error(F.lit(f"two cells of one item and period in a {report!r} sheet")).cast("double")
    cell = F.when(F.count("period") > 1, twice).otherwise(F.max("value"))
    keys = rows.groupBy("Symbol", "pos", "item")
    wide = keys.pivot("period", list(periods)).agg(cell) if periods else keys.agg(F.count("value").alias("__n")).drop("__n")
    wide = wide.withColumnRenamed("item", ITEM_TITLES[report])
    return wide.toDF(*[X.underscore_name(c) for c in wide.columns])


def annual_cashflow(long: DataFrame, periods: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """10-K cash-flow report (report 'cf', 12-month periods)."""
    return format_sheet(long, "cf", periods, freq=12, strict=strict)


def quarterly_cashflow(long: DataFrame, periods: Sequence[str] | None = None, strict: bool = True) -> DataFrame:
    """10-Q cash-flow report (report 'cf', 3-month periods)."""
    return format_sheet(long, "cf", periods, freq=3, strict=strict)
