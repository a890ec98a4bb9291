"""Job inputs derived from the driver's TPC-H-like tables.

Each adapter is a narrow projection (no join, no shuffle) over one whole table,
so its size grows with the table. The rules that shape the data -- which rows
read 'n/a', which symbols are newly listed -- are fixture shaping, applied to
every row; nothing is sampled or capped. The SQL twin of every adapter lives in
``tickerlake.plans.oracle`` and must stay in step with this file.

Shapes:
- listing: NASDAQ rows from ``customer`` (Symbol 'T <key>', inner blank) and
  NYSE rows from ``part`` (Symbol 'T<key>'): after blank removal the lists
  overlap, so the first-per-Symbol rule and the 'n/a' rule interact.
- prices: one row per ``lineitem`` row, Symbol 'S<partkey>'. Stored history is
  the rows with line status 'F'; the fresh download is every row. Symbols whose
  key ends in 3 are newly listed (no stored history) and those ending in 7 are
  delisted (empty download).
- key lists: 'S<custkey>' with a Market, NULL Market for negative balances.
- ticker changes: one per supplier, 'S<k>' -> 'S<k+1>', applied in order of
  (s_acctbal, s_suppkey), so some chains compose and some do not.
- dividends: past = orders with status 'F', announced = status 'O'.
- sheets: one long row per order; report/freq from the order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.operators.clean import price_history

# Fixed value: the first header cell of every generated sheet.
SHEET_LABEL = "Fiscal year ends in December. USD in millions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; its splits follow ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# -- listings -----------------------------------------------------------------

def listing_nasdaq(spark: SparkSession, sf_dir: str, prefix: str = "T",
                   skip_segment: str | None = None) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    if skip_segment is not None:
        c = c.where(F.col("c_mktsegment") != skip_segment)
    cap = (F.when(F.col("c_acctbal") < 0, F.lit("n/a"))
           .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
           .otherwise(F.concat(F.lit("$"), _s("c_nationkey"), F.lit(".5"),
                               F.when(F.col("c_acctbal") > 5000, F.lit("B")).otherwise(F.lit("M")))))
    return c.select(
        F.concat(F.lit(prefix + " "), _s("c_custkey")).alias("Symbol"),
        F.col("c_name").alias("Name"),
        (F.col("c_acctbal") / 3).cast("string").alias("LastSale"),
        cap.alias("MarketCap"),
        F.col("c_mktsegment").alias("industry"),
        F.concat(F.lit("quote "), _s("c_custkey")).alias("Summary Quote"),
        F.lit(None).cast("string").alias("Unnamed: 8"),
        F.col("c_custkey").alias("pos"),
    )


def listing_nyse(spark: SparkSession, sf_dir: str, prefix: str = "T") -> DataFrame:
    p = table(spark, sf_dir, "part")
    cap = (F.when(F.col("p_size") > 45, F.lit("n/a"))
           .otherwise(F.concat(F.lit("$"), _s("p_size"), F.lit(".25"),
                               F.when(F.col("p_retailprice") > 950, F.lit("B")).otherwise(F.lit("M")))))
    return p.select(
        F.concat(F.lit(prefix), _s("p_partkey")).alias("Symbol"),
        F.col("p_name").alias("Name"),
        (F.col("p_retailprice") / 3).cast("string").alias("LastSale"),
        cap.alias("MarketCap"),
        F.col("p_type").alias("industry"),
        F.concat(F.lit("quote "), _s("p_partkey")).alias("Summary Quote"),
        F.lit(None).cast("string").alias("Unnamed: 8"),
        F.col("p_partkey").alias("pos"),
    )


def messy(listing: DataFrame) -> DataFrame:
    """A listing among whose sales and market caps some read as no number."""
    return (listing.withColumn("LastSale", F.when(F.col("pos") % 23 == 0, F.lit("call")).when(F.col("pos") % 29 == 0, F.lit("n/a")).otherwise(F.col("LastSale")))
            .withColumn("MarketCap", F.when(F.col("pos") % 31 == 0, F.lit("$1.5K")).otherwise(F.col("MarketCap"))))


# -- prices -------------------------------------------------------------------

def _lineitem_prices(li: DataFrame) -> DataFrame:
    date_text = (F.when(F.col("l_quantity") >= 50, F.lit("13/45/2017"))
                 .otherwise(F.date_format("l_shipdate", "M/d/yyyy")))
    qty = F.col("l_quantity").cast("bigint").cast("string")
    volume = (F.when(F.col("l_linenumber") == 7, F.lit("???"))
              .when(F.col("l_returnflag") == "A", qty)
              .otherwise(F.concat(qty, F.lit(","), F.lpad(_s("l_linenumber"), 3, "0"))))
    return li.select(
        F.concat(F.lit("S"), _s("l_partkey")).alias("Symbol"),
        date_text.alias("Date"),
        F.col("l_extendedprice").alias("Open"),
        (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("High"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("Low"),
        F.col("l_extendedprice").alias("Close"),
        volume.alias("Volume"),
    )


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every price row as the source files carry it (text dates and volumes)."""
    return _lineitem_prices(table(spark, sf_dir, "lineitem"))


def prices_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored price history: cleaned rows with line status 'F', newly listed symbols absent."""
    li = table(spark, sf_dir, "lineitem")
    li = li.where((F.col("l_linestatus") == "F") & (F.col("l_partkey") % 10 != 3))
    return price_history(_lineitem_prices(li))


def prices_stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows behind ``prices_stored`` (what an initial load reads)."""
    li = table(spark, sf_dir, "lineitem")
    return _lineitem_prices(li.where((F.col("l_linestatus") == "F") & (F.col("l_partkey") % 10 != 3)))


def prices_download(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows behind ``prices_incoming`` (a full re-download)."""
    return _lineitem_prices(table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 10 != 7))


def prices_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fresh full download, cleaned; delisted symbols return nothing."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 10 != 7)
    return price_history(_lineitem_prices(li))


# -- key lists and ticker changes -----------------------------------------------

def _keys(c: DataFrame) -> DataFrame:
    market = (F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
              .when(F.col("c_nationkey") < 12, F.lit("NYSE")).otherwise(F.lit("NASDAQ")))
    return c.select(F.concat(F.lit("S"), _s("c_custkey")).alias("Symbol"), market.alias("Market"))


def keys_db(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key table as stored: every customer outside the AUTOMOBILE segment."""
    c = table(spark, sf_dir, "customer")
    return _keys(c.where(F.col("c_mktsegment") != "AUTOMOBILE"))


def keys_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current listing's keys: every customer outside the BUILDING segment."""
    c = table(spark, sf_dir, "customer")
    return _keys(c.where(F.col("c_mktsegment") != "BUILDING"))


def ticker_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    date = (F.when(F.col("s_nationkey") == 0, F.lit(None).cast("string"))
            .otherwise(F.date_format(F.make_date(F.lit(2017), F.lit(1), F.lit(1)), "yyyy-MM-dd")))
    return s.select(
        F.struct(F.col("s_acctbal").alias("bal"), F.col("s_suppkey").alias("key")).alias("pos"),
        F.concat(F.lit("S"), _s("s_suppkey")).alias("Old"),
        F.concat(F.lit("S"), (F.col("s_suppkey") + 1).cast("string")).alias("New"),
        date.alias("Date"),
    )


# -- dividends ------------------------------------------------------------------

def _dividends(o: DataFrame) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cents = F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0")
    amount = (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("USD 0."), cents))
              .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("0."), cents, F.lit("USD")))
              .otherwise(F.concat(F.lit("$0."), cents)))
    return o.select(
        F.concat(F.lit("S"), _s("o_custkey")).alias("Symbol"),
        day.alias("Ex-Dividend Date"),
        day.alias("Declaration Date"),
        day.alias("Record Date"),
        day.alias("Payable Date"),
        F.lit("Cash").alias("Dividend Type"),
        amount.alias("Amount"),
    )


def dividends_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return _dividends(o.where(F.col("o_orderstatus") == "F"))


def dividends_upcoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return _dividends(o.where(F.col("o_orderstatus") == "O"))


def dividends_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dividends already stored: past ones of orders placed before March 1995."""
    o = table(spark, sf_dir, "orders")
    return _dividends(o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.lit("1995-03-01").cast("timestamp_ntz"))))


# -- financial sheets (long form) -------------------------------------------------

def _sheets(o: DataFrame) -> DataFrame:
    report = (F.when(F.col("o_orderkey") % 3 == 0, F.lit("is"))
              .when(F.col("o_orderkey") % 3 == 1, F.lit("bs")).otherwise(F.lit("cf")))
    freq = F.when(F.col("o_orderkey") % 2 == 0, F.lit(12)).otherwise(F.lit(3))
    period = (F.when(freq == 12, F.date_format("o_orderdate", "yyyy"))
              .otherwise(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-Q"),
                                  F.quarter("o_orderdate").cast("string"))))
    return o.select(
        F.concat(F.lit("S"), _s("o_custkey")).alias("Symbol"),
        report.alias("report"),
        freq.alias("freq"),
        F.col("o_orderkey").alias("pos"),  # one cell per order: no two cells share (sheet, pos, period)
        F.col("o_orderpriority").alias("item"),
        F.lit(SHEET_LABEL).alias("label"),
        period.alias("period"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("value"),
    )


def sheets_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sheet cell: the incoming reports."""
    return _sheets(table(spark, sf_dir, "orders"))


def sheets_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming reports among which some have a report code or a frequency that no table takes."""
    long = sheets_long(spark, sf_dir)
    return (long.withColumn("report", F.when(F.col("pos") % 29 == 0, F.lit("zz")).otherwise(F.col("report")))
            .withColumn("freq", F.when(F.col("pos") % 31 == 0, F.lit(6)).otherwise(F.col("freq"))))


def sheets_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets already stored: cells of orders placed before 1997."""
    o = table(spark, sf_dir, "orders")
    return _sheets(o.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")))


def sheets_with_ttm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sheet cell, and for each line an empty cell of the twelve months under way."""
    long = sheets_long(spark, sf_dir)
    return long.unionByName(long.withColumn("period", F.lit("TTM")).withColumn("value", F.lit(None).cast("double")))
