"""One pass over a price download, and the outcome of every requested report.

``tag_prices`` decides for each raw row what becomes of it; ``folded`` then keeps the
rows to store and only counts the others, in one aggregate: rows to store are groups
of their own (equal ones with their number), all others fold into one row per
symbol and tag, map-side. So one scan of a download gives both what is
written and every per-symbol count, and a re-download of ten years shuffles its new days
and a few counts per symbol.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake.functions import exprs as X
from tickerlake.operators import clean, history

# What becomes of a downloaded price row.
NEWER = "newer"              # stored: later than the symbol's last stored date
BRAND_NEW = "brand_new"      # stored: the symbol has no stored history yet
KNOWN = "known"              # already stored
NO_MARK = "no_mark"          # a listed old symbol without stored history: not stored
REFUSED = "refused"          # a new symbol that has stored history: not stored
BAD_DATE = "bad_date"        # the date does not parse: not stored
KEPT = (NEWER, BRAND_NEW)

# Outcomes of one requested report.
COMMITTED, ALREADY_PRESENT, EMPTY_REPORT = history.COMMITTED, "already_present", "empty_report"
NO_REPORT, NO_DIVIDENDS, NO_PRICES = "no_report", "no_dividend_history", history.NO_PRICE_HISTORY

#: Columns of a price row that hold numbers; a bit each in ``bad_cells``.
NUMBERS = ("Open", "High", "Low", "Close", "Volume")
#: Texts that stand for a missing number and are not rejects.
MISSING = ("", "n/a")


# --- numbers that do not read as numbers ----------------------------------------------------------------------------

def is_reject(raw: Column, value: Column) -> Column:
    """A cell that holds a text, yet no number."""
    text = F.trim(raw.cast("string"))
    return text.isNotNull() & ~text.isin(*MISSING) & value.isNull()


def bad_cells(raw: DataFrame) -> Column:
    """Bits of the price columns whose text is no number (they are stored as NULL)."""
    there = dict(raw.dtypes)
    bits = [F.when(is_reject(F.col(f"`{c}`"), X.volume_number(F.col(f"`{c}`")) if c == "Volume" else X.to_number(F.col(f"`{c}`"))), F.lit(1 << i))
            .otherwise(0) for i, c in enumerate(NUMBERS) if there.get(c) == "string"]
    return reduce(lambda a, b: a + b, bits, F.lit(0)).cast("int")


def cell_counts(rows: DataFrame, n: Column) -> DataFrame:
    """(Symbol, column, n_cells) from rows with ``bad_cells``, each standing for ``n`` rows; one partial aggregate."""
    sums = rows.where("bad_cells > 0").groupBy("Symbol").agg(
        *[F.sum(F.when(F.col("bad_cells").bitwiseAND(1 << i) > 0, n).otherwise(0)).alias(c) for i, c in enumerate(NUMBERS)])
    return _unpivoted(sums, NUMBERS)


def _unpivoted(sums: DataFrame, columns) -> DataFrame:
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("n_cells")) for c in columns])).alias("c")
    return sums.select("Symbol", cells).select("Symbol", "c.column", "c.n_cells").where("n_cells > 0")


def price_number_rejects(raw: DataFrame) -> DataFrame:
    """(Symbol, column, n_cells): cells of dated price rows that hold a text, yet no number."""
    good = raw.where(X.parse_us_date("Date").isNotNull())
    return cell_counts(good.select("Symbol", bad_cells(good).alias("bad_cells")), F.lit(1))


def listing_number_rejects(nasdaq: DataFrame, nyse: DataFrame) -> DataFrame:
    """(Symbol, column, n_cells): listing cells LastSale and MarketCap that hold a text, yet no number.

    Rows whose MarketCap reads 'n/a' are no part of the cleaned listing and not counted.
    """
    both = nasdaq.select("Symbol", "LastSale", "MarketCap").unionByName(nyse.select("Symbol", "LastSale", "MarketCap"))
    cap = F.regexp_replace(F.col("MarketCap").cast("string"), X.MARKET_CAP_NUMBER_DROP, "")
    rows = both.select(X.strip_whitespace("Symbol").alias("Symbol"), "LastSale", cap.alias("MarketCap"))
    rows = rows.where(~F.col("MarketCap").eqNullSafe("n/a") & F.col("Symbol").isNotNull())
    sums = rows.groupBy("Symbol").agg(*[F.count(F.when(is_reject(F.col(c), X.to_number(c)), True)).alias(c) for c in ("LastSale", "MarketCap")])
    return _unpivoted(sums, ("LastSale", "MarketCap"))


# --- one pass over the prices ---------------------------------------------------------------------------------------

def scope(old: DataFrame, new: DataFrame, latest: DataFrame) -> DataFrame:
    """(Symbol, is_new, last_reference): one row per listed symbol, what the tagging of its rows needs."""
    listed = old.select("Symbol", F.lit(False).alias("is_new")).unionByName(new.select("Symbol", F.lit(True).alias("is_new")))
    listed = listed.where(F.col("Symbol").isNotNull()).groupBy("Symbol").agg(F.bool_and("is_new").alias("is_new"))
    marks = latest.groupBy("Symbol").agg(F.max("last_reference").alias("last_reference"))
    return listed.join(marks, "Symbol", "left")


def tag_prices(raw: DataFrame, symbols: DataFrame) -> DataFrame:
    """Price rows of the listed symbols, cleaned, with ``tag`` and ``bad_cells``; rows of other symbols are left out."""
    rows = clean.price_rows(raw.withColumn("bad_cells", bad_cells(raw)), "bad_cells")
    # ``symbols`` has one small row per symbol: broadcast by AQE, or shuffled with a hot symbol's rows split.
    rows = rows.join(symbols, "Symbol")
    marked = F.col("last_reference").isNotNull()
    tag = (F.when(F.col("Reference").isNull(), BAD_DATE)
           .when(F.col("is_new"), F.when(marked, REFUSED).otherwise(BRAND_NEW))
           .when(~marked, NO_MARK)
           .when(F.col("Reference") > F.col("last_reference"), NEWER)
           .otherwise(KNOWN))
    return rows.withColumn("tag", tag).drop("is_new", "last_reference")


def folded(tagged: DataFrame) -> DataFrame:
    """One row per (row to store, how often) and one per (symbol, other tag), with ``n_rows``: one aggregate."""
    kept = F.col("tag").isin(*KEPT)
    keys = [F.col("Symbol"), F.col("tag"), *[F.when(kept, F.col(c)).alias(c) for c in (*clean.PRICE_COLUMNS[1:], "bad_cells")]]
    return tagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def unfolded(rows: DataFrame) -> DataFrame:
    """Rows to store each as often as they came (``n_rows`` 1); the counts of the others as they are."""
    kept = F.col("tag").isin(*KEPT)
    each = F.sequence(F.lit(1).cast("long"), F.when(kept, F.col("n_rows")).otherwise(F.lit(1)))
    one = F.when(kept, F.lit(1)).otherwise(F.col("n_rows")).cast("long")
    return rows.withColumn("__i", F.explode(each)).drop("__i").withColumn("n_rows", one)


def tag_counts(rows: DataFrame) -> DataFrame:
    """(Symbol, n_newer, n_brand_new, ...): rows per symbol and tag, from rows that each stand for ``n_rows``."""
    return rows.groupBy("Symbol").agg(*[F.coalesce(F.sum(F.when(F.col("tag") == t, F.col("n_rows"))), F.lit(0)).cast("long").alias(f"n_{t}")
                                        for t in (NEWER, BRAND_NEW, KNOWN, NO_MARK, REFUSED, BAD_DATE)])


def price_outcomes(symbols: DataFrame, counts: DataFrame) -> DataFrame:
    """(Symbol, is_new, status, n_rows): one status per listed symbol, from the counts of its tags.

    Old symbols in the order of the checks: no stored history, nothing (dated) downloaded, nothing
    newer, committed. New ones: nothing downloaded, refused because history is stored, committed.
    """
    n = lambda t: F.coalesce(F.col(f"n_{t}"), F.lit(0))
    old = (F.when(F.col("last_reference").isNull(), history.NOT_IN_HISTORY).when(n(NEWER) + n(KNOWN) == 0, NO_PRICES)
           .when(n(NEWER) == 0, history.ALREADY_LATEST).otherwise(COMMITTED))
    new = F.when(n(BRAND_NEW) + n(REFUSED) == 0, NO_PRICES).when(n(REFUSED) > 0, ALREADY_PRESENT).otherwise(COMMITTED)
    out = symbols.join(counts, "Symbol", "left").withColumn("status", F.when(F.col("is_new"), new).otherwise(old))
    return out.select("Symbol", "is_new", "status", F.when(F.col("status") == COMMITTED, n(NEWER) + n(BRAND_NEW)).otherwise(0).cast("long").alias("n_rows"))


# --- outcomes of sheets and dividends -------------------------------------------------------------------------------

def sheet_counts(rows: DataFrame) -> DataFrame:
    """(Symbol, report, freq, n_raw, n_live): lines times periods of each sheet, and those in periods that hold a value."""
    keys = ["Symbol", "report", "freq"]
    periods = rows.groupBy(*keys, "period").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("live"))
    return periods.groupBy(*keys).agg(F.sum("n").alias("n_raw"), F.sum(F.when(F.col("live") > 0, F.col("n")).otherwise(0)).alias("n_live"))


def _requested_sheets(requested: DataFrame) -> DataFrame:
    kinds = F.array(*[F.struct(F.lit(r).alias("report"), F.lit(f).alias("freq")) for r, f in history.SHEET_TABLES])
    return (requested.select("Symbol").where(F.col("Symbol").isNotNull()).distinct()
            .select("Symbol", F.explode(kinds).alias("k")).select("Symbol", "k.report", "k.freq"))


def sheet_outcomes(requested: DataFrame, rows: DataFrame, stored: DataFrame) -> DataFrame:
    """(Symbol, report, freq, outcome, n_rows): each of the six sheets of every requested symbol, and any unknown kind.

    A sheet without lines is ``no_report``, one already stored ``already_present``, one whose
    periods are all empty ``empty_report``; kinds that no table takes are ``unknown_report``.
    """
    keys = ["Symbol", "report", "freq"]
    counts = sheet_counts(rows.join(requested.select("Symbol").distinct(), "Symbol", "left_semi"))
    known = history.sheet_table_name().isNotNull()
    there = history.present_keys(stored, keys).withColumn("__stored", F.lit(True))
    out = _requested_sheets(requested).join(counts.where(known), keys, "left").join(there, keys, "left")
    outcome = (F.when(F.coalesce("n_raw", F.lit(0)) == 0, NO_REPORT).when(F.col("__stored"), ALREADY_PRESENT)
               .when(F.col("n_live") == 0, EMPTY_REPORT).otherwise(COMMITTED))
    out = out.withColumn("outcome", outcome).select(*keys, "outcome", F.when(F.col("outcome") == COMMITTED, F.col("n_live")).otherwise(0).cast("long").alias("n_rows"))
    odd = counts.where(F.coalesce(~known, F.lit(True))).select(*keys, F.lit(history.UNKNOWN_REPORT).alias("outcome"), F.col("n_raw").cast("long").alias("n_rows"))
    return out.unionByName(odd)


def dividend_outcomes(requested: DataFrame, rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    """(Symbol, outcome, n_rows): the dividend history of every requested symbol; ``rows`` is what ``dividend_history`` gives."""
    asked = requested.select("Symbol").where(F.col("Symbol").isNotNull()).distinct()
    counts = rows.groupBy("Symbol").agg(F.count(F.lit(1)).alias("n"))
    out = asked.join(counts, "Symbol", "left")
    if stored is None:
        out = out.withColumn("__stored", F.lit(None).cast("boolean"))
    else:
        out = out.join(history.present_keys(stored, ["Symbol"]).withColumn("__stored", F.lit(True)), "Symbol", "left")
    outcome = F.when(F.col("n").isNull(), NO_DIVIDENDS).when(F.col("__stored"), ALREADY_PRESENT).otherwise(COMMITTED)
    out = out.withColumn("outcome", outcome)
    return out.select("Symbol", "outcome", F.when(F.col("outcome") == COMMITTED, F.col("n")).otherwise(0).cast("long").alias("n_rows"))


def report_outcomes(requested: DataFrame, sheet_rows: DataFrame, stored_sheets: DataFrame,
                    dividend_rows: DataFrame, stored_dividends: DataFrame | None) -> DataFrame:
    """(Symbol, report, freq, outcome, n_rows) of every report of every requested symbol; dividends are report 'div'."""
    div = dividend_outcomes(requested, dividend_rows, stored_dividends)
    div = div.select("Symbol", F.lit("div").alias("report"), F.lit(None).cast("int").alias("freq"), "outcome", "n_rows")
    return sheet_outcomes(requested, sheet_rows, stored_sheets).unionByName(div)
