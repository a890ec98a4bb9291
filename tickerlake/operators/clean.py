"""Cleaning jobs: exchange listings, price files, column-level tidying.

All of them are narrow projections/filters except ``first_per_key`` (one
aggregation with map-side partial aggregation) and ``drop_null_columns`` (one
counting action, because the output schema depends on the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerlake.functions import exprs as X

PRICE_COLUMNS = ["Symbol", "Reference", "Open", "High", "Low", "Close", "Volume"]
LISTING_DROP = ["Unnamed: 8", "Summary Quote"]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that comes first by ``order`` (ties: any).

    ``min_by`` over a struct is a declarative aggregate, so Spark combines rows
    map-side before the shuffle: a key holding a third of all rows still sends
    one row per input partition, and nothing is sorted.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    rank = F.struct(*[F.col(f"`{c}`") for c in order])
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min_by(row, rank).alias("__row"))
    return picked.select(*[F.col(f"`{c}`") if c in keys else F.col("__row").getField(c).alias(c)
                           for c in df.columns])


def listing_clean(nasdaq: DataFrame, nyse: DataFrame, order_col: str = "pos",
                  keep_order_col: bool = False, drop_unsold: bool = False) -> DataFrame:
    """Two raw exchange lists -> one cleaned listing, first row per Symbol.

    Step order matters: rows whose MarketCap reads 'n/a' vanish *before* the
    first-per-Symbol pick, so such a NASDAQ row does not hide the NYSE one.
    ``order_col`` is the row position inside each file. ``drop_unsold`` leaves out
    rows without a last sale (the default keeps them, as the source does).
    """
    tagged = (nasdaq.withColumn("Market", F.lit("NASDAQ")).withColumn("__src", F.lit(0))
              .unionByName(nyse.withColumn("Market", F.lit("NYSE")).withColumn("__src", F.lit(1)),
                           allowMissingColumns=True))
    tagged = tagged.drop(*[c for c in LISTING_DROP if c in tagged.columns])
    raw_cap = F.col("MarketCap").cast("string")
    cleaned = (tagged
               .withColumn("LastSale", X.to_number("LastSale"))
               .withColumn("MarketCapSym", F.regexp_replace(raw_cap, X.MARKET_CAP_UNIT_DROP, ""))
               .withColumn("MarketCap", F.regexp_replace(raw_cap, X.MARKET_CAP_NUMBER_DROP, ""))
               .withColumn("Symbol", X.strip_whitespace("Symbol"))
               .where(~F.col("MarketCap").eqNullSafe("n/a"))
               .withColumn("MarketCap", X.to_number("MarketCap"))
               .withColumn("LastSale", X.round_half_even("LastSale", 2))
               .withColumnRenamed("industry", "Industry")
               .where(F.col("Symbol").isNotNull()))
    if drop_unsold:
        cleaned = cleaned.where(F.col("LastSale").isNotNull())
    first = first_per_key(cleaned, ["Symbol"], ["__src", order_col])
    out = first.drop("__src")
    return out if keep_order_col else out.drop(order_col)


def price_rows(raw: DataFrame, *extra: str, symbol: str | None = None) -> DataFrame:
    """Raw price rows -> (Symbol, Reference date, Open, High, Low, Close, Volume) and the columns ``extra``.

    Missing columns become NULL, extra ones are dropped. 'm/d/yyyy' dates are
    parsed strictly; a date that does not parse is NULL. Volume keeps digits only
    when the text is a number once thousands separators are gone.
    """
    types = dict(raw.dtypes)

    def pick(name: str) -> Column:
        return F.col(f"`{name}`") if name in types else F.lit(None)

    def number(name: str) -> Column:
        if types.get(name) in ("double", "float", "int", "bigint", "smallint", "tinyint") or \
                str(types.get(name, "")).startswith("decimal"):
            return F.col(f"`{name}`").cast("double")
        return X.to_number(pick(name))

    sym = pick("Symbol") if symbol is None else F.lit(symbol)
    return raw.select(
        sym.cast("string").alias("Symbol"),
        X.parse_us_date(pick("Date")).alias("Reference"),
        *[number(c).alias(c) for c in ("Open", "High", "Low", "Close")],
        X.volume_number(pick("Volume")).alias("Volume"),
        *extra,
    )


def price_history(raw: DataFrame, symbol: str | None = None) -> DataFrame:
    """``price_rows`` without the rows whose date does not parse (see ``price_rejects``)."""
    return price_rows(raw, symbol=symbol).where(F.col("Reference").isNotNull())


def price_rejects(raw: DataFrame) -> DataFrame:
    """Per symbol, how many raw price rows had a date that does not parse."""
    bad = raw.where(X.parse_us_date("Date").isNull())
    return bad.groupBy("Symbol").agg(F.count(F.lit(1)).alias("n_bad_dates"))


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are NULL in every row (an empty frame loses all).

    The output schema depends on the data, so this runs one aggregation action:
    a single pass with one ``count`` per column, partially aggregated.
    """
    if not df.columns:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def underscore_columns(df: DataFrame) -> DataFrame:
    """Rename every column: spaces become underscores (metadata only)."""
    return df.toDF(*[X.underscore_name(c) for c in df.columns])


def key_first(df: DataFrame, key: str | None = None) -> DataFrame:
    """Move ``key`` (default: the last column) to the front."""
    if not df.columns:
        return df
    key = key or df.columns[-1]
    return df.select(F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in df.columns if c != key])


def split_amount(df: DataFrame, col: str = "Amount") -> DataFrame:
    """Currency = leading capitals of the amount text; Amount loses capitals and '$'."""
    return (df.withColumn("Currency", X.leading_capitals(col))
              .withColumn(col, X.strip_amount(col)))
