import datetime as dt

import pytest

from helpers import rows
from tickerlake.operators import clean

LISTING_COLS = "Symbol string, Name string, LastSale string, MarketCap string, industry string, " \
               "`Summary Quote` string, `Unnamed: 8` string, pos long"


def test_listing_clean_edge_cases(spark):
    nasdaq = spark.createDataFrame([
        ("AB C", "abc inc", "1.015", "$1.5M", "Tech", "q", None, 1),
        ("DUP", "dup nasdaq", "2.0", "n/a", "Tech", "q", None, 2),     # n/a row must not hide NYSE DUP
        ("NA", "na corp", "0.125", "$30.5B", "Fin", "q", None, 3),      # ticker literally NA is kept
        ("BLNK", "blank cap", "3.333", None, "Fin", "q", None, 4),      # blank MarketCap kept as NULL
        ("JUNK", "junk sale", "n/a", "$2M", "Fin", "q", None, 5),       # unparseable LastSale -> NULL
        ("ABC", "second abc", "9.0", "$1M", "Tech", "q", None, 6),      # later duplicate of 'AB C'
        (None, "no symbol", "1.0", "$1M", "Tech", "q", None, 7),
    ], LISTING_COLS)
    nyse = spark.createDataFrame([
        ("DUP", "dup nyse", "4.0", "$7.25B", "Ind", "q", None, 1),
        ("ABC", "abc nyse", "5.0", "$1M", "Ind", "q", None, 2),
    ], LISTING_COLS)
    out = clean.listing_clean(nasdaq, nyse)
    assert "Summary Quote" not in out.columns and "Unnamed: 8" not in out.columns
    got = {r.Symbol: r for r in out.collect()}
    assert set(got) == {"ABC", "DUP", "NA", "BLNK", "JUNK"}
    assert got["ABC"].Name == "abc inc" and got["ABC"].LastSale == 1.01      # half-even on the double
    assert got["ABC"].Market == "NASDAQ" and got["ABC"].MarketCap == 1.5 and got["ABC"].MarketCapSym == "M"
    assert got["DUP"].Market == "NYSE" and got["DUP"].MarketCap == 7.25 and got["DUP"].MarketCapSym == "B"
    assert got["NA"].LastSale == 0.12
    assert got["BLNK"].MarketCap is None and got["BLNK"].MarketCapSym is None
    assert got["JUNK"].LastSale is None


def test_first_per_key_is_order_based(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), ("a", 3, "w")], "k string, o int, v string")
    assert rows(clean.first_per_key(df, ["k"], ["o"])) == [("a", 1, "y"), ("b", 5, "z")]


def test_price_history_cleaning(spark):
    raw = spark.createDataFrame([
        ("ACME", "1/5/2017", "1", "2", "1", "2", "1,234"),
        ("ACME", "01/06/2017", "2", "3", "2", "3", "???"),
        ("ACME", "1/7/2017", "2", "3", "2", "3", "1d"),
        ("ACME", "1/8/2017", "2", "3", "2", "3", " 12 "),
        ("ACME", "1/9/2017", "2", "3", "2", "3", ""),
        ("ACME", "13/45/2017", "2", "3", "2", "3", "5"),
    ], "Symbol string, Date string, Open string, High string, Low string, Close string, Volume string")
    out = clean.price_history(raw)
    assert out.columns == clean.PRICE_COLUMNS
    got = rows(out, "Reference", "Volume")
    assert got == [(dt.date(2017, 1, 5), 1234.0), (dt.date(2017, 1, 6), None), (dt.date(2017, 1, 7), None),
                   (dt.date(2017, 1, 8), 12.0), (dt.date(2017, 1, 9), None)]
    assert rows(clean.price_rejects(raw)) == [("ACME", 1)]


def test_price_history_missing_and_numeric_columns(spark):
    raw = spark.createDataFrame([("X", "2/3/2020", 1.5, 7)], "Symbol string, Date string, Open double, Volume int")
    r = clean.price_history(raw).first()
    assert r.Open == 1.5 and r.High is None and r.Volume == 7.0


def test_split_amount(spark):
    df = spark.createDataFrame([("$0.5",), ("USD 0.5",), ("0.5USD",), (None,)], "Amount string")
    got = rows(clean.split_amount(df), "Amount", "Currency")
    assert got == [(None, None), (" 0.5", "USD"), ("0.5", ""), ("0.5", "")]


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "a int, b string, c string")
    assert clean.drop_null_columns(df).columns == ["a", "c"]
    empty = spark.createDataFrame([], "a int, b string")
    assert clean.drop_null_columns(empty).columns == []


def test_underscore_and_key_first(spark):
    df = spark.createDataFrame([(1, 2, "S")], "`Ex-Dividend Date` int, `Dividend Type` int, Symbol string")
    assert clean.underscore_columns(df).columns == ["Ex-Dividend_Date", "Dividend_Type", "Symbol"]
    assert clean.key_first(df).columns == ["Symbol", "Ex-Dividend Date", "Dividend Type"]


@pytest.mark.parametrize("x", [1.015, 0.125, 2.675, -1.005, 0.285, 1.255, 12345.675])
def test_round_half_even_matches_pandas(spark, x):
    import pandas as pd
    from pyspark.sql import functions as F
    from tickerlake.functions import round_half_even
    got = spark.range(1).select(round_half_even(F.lit(x)).alias("r")).first().r
    assert got == pd.Series([x]).round(2)[0]
