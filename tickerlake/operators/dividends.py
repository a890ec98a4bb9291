"""Dividend tables: past payments plus announced (upcoming) ones."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerlake.functions import exprs as X
from tickerlake.operators.clean import split_amount, underscore_columns
from tickerlake.operators.history import present_keys

# The raw dividend columns in stored order.
DIVIDEND_COLUMNS = ["Symbol", "Ex-Dividend Date", "Declaration Date", "Record Date",
                    "Payable Date", "Dividend Type", "Amount"]


def dividend_history(past: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Past and upcoming dividends in one table.

    Upcoming rows are kept only for symbols that have past rows (a symbol with
    announcements only counts as having no dividend history). Columns are put in
    the stored order, Amount is split into Currency and the amount text, and
    spaces in column names become underscores.
    """
    gated = upcoming.join(present_keys(past, ["Symbol"]), "Symbol", "left_semi")
    both = past.unionByName(gated, allowMissingColumns=True)
    have = set(both.columns)
    fixed = both.select(*[(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c)
                          for c in DIVIDEND_COLUMNS])
    return underscore_columns(split_amount(fixed, "Amount"))


def dividend_window(div: DataFrame, as_of, years: int, date_col: str = "Ex-Dividend_Date") -> DataFrame:
    """Dividends whose ex-date falls after ``as_of`` minus ``years`` years.

    Announced (future) rows pass too; rows whose ex-date does not parse are out.
    """
    if isinstance(as_of, (_dt.date, str)):
        as_of = F.to_date(F.lit(str(as_of)))
    start = F.add_months(as_of, -12 * int(years))
    return div.where(X.parse_iso_or_us_date(date_col) > start)
