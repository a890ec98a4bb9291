import pytest

from helpers import rows
from tickerlake.operators import dividends, sheets

SHEET = "Symbol string, report string, freq int, pos long, item string, label string, period string, value double"
LABEL = "Fiscal year ends in December. USD in millions"


def _sheet(spark, label=LABEL):
    return spark.createDataFrame([
        ("A", "cf", 12, 1, "Cash, operating", label, "2015", 10.0),
        ("A", "cf", 12, 1, "Cash, operating", label, "2016", 20.0),
        ("A", "cf", 12, 1, "Cash, operating", label, "TTM", None),
        ("A", "cf", 12, 2, "Section", label, "2015", None),
        ("A", "cf", 12, 2, "Section", label, "2016", None),
        ("A", "cf", 12, 2, "Section", label, "TTM", None),
        ("B", "cf", 12, 1, "Cash, operating", label, "TTM", 5.0),
    ], SHEET)


def test_drop_null_periods(spark):
    got = rows(sheets.drop_null_periods(_sheet(spark)), "Symbol", "pos", "period")
    # A's TTM column is NULL for every item -> gone; B's TTM stays; the section row stays.
    assert got == [("A", 1, "2015"), ("A", 1, "2016"), ("A", 2, "2015"), ("A", 2, "2016"), ("B", 1, "TTM")]


def test_format_sheet_wide(spark):
    wide = sheets.annual_cashflow(_sheet(spark), ["2015", "2016", "TTM"])
    assert wide.columns == ["Symbol", "pos", "Cashflow_item", "2015", "2016", "TTM"]
    assert rows(wide) == [("A", 1, "Cash, operating", 10.0, 20.0, None), ("A", 2, "Section", None, None, None),
                          ("B", 1, "Cash, operating", None, None, 5.0)]
    assert sheets.quarterly_cashflow(_sheet(spark), ["2016-Q1"]).count() == 0


def test_format_sheet_requires_fiscal_label(spark):
    with pytest.raises(Exception, match="Fiscal"):  # raised where the rows are read: building the report runs no job
        sheets.format_sheet(_sheet(spark, label="Something else"), "cf", ["2015"], freq=12).collect()
    assert sheets.format_sheet(_sheet(spark, label="Other"), "cf", ["2015"], freq=12, strict=False).count() == 0
    with pytest.raises(ValueError):
        sheets.format_sheet(_sheet(spark), "xx", ["2015"])


def test_format_sheet_keeps_every_live_period_and_rejects_double_cells(spark):
    df = spark.createDataFrame([("A", "is", 3, 1, "x", LABEL, "2014-Q1", 1.0), ("A", "is", 3, 2, "y", LABEL, "2015-Q1", None),
                                ("B", "is", 3, 1, "x", LABEL, "1999-Q4", 3.0)], SHEET)
    assert sheets.format_sheet(df, "is", freq=3).columns == ["Symbol", "pos", "Income_item", "1999-Q4", "2014-Q1"]
    assert rows(sheets.format_sheet(df.where("value is null"), "is", freq=3)) == [("A", 2, "y")]
    with pytest.raises(Exception, match="two cells"):
        sheets.format_sheet(df.unionByName(df), "is", freq=3).collect()


DIV = "Symbol string, `Ex-Dividend Date` string, `Declaration Date` string, `Record Date` string, " \
      "`Payable Date` string, `Dividend Type` string, Amount string"


def test_dividend_history_gates_upcoming(spark):
    past = spark.createDataFrame([("P", "2019-01-02", None, None, None, "Cash", "$0.5"),
                                  ("P", "2018-01-02", None, None, None, "Cash", "USD 0.4")], DIV)
    upcoming = spark.createDataFrame([("P", "2020-03-01", None, None, None, "Cash", "0.6USD"),
                                      ("U", "2020-03-01", None, None, None, "Cash", "$1")], DIV)
    out = dividends.dividend_history(past, upcoming.drop("Record Date"))
    assert out.columns == ["Symbol", "Ex-Dividend_Date", "Declaration_Date", "Record_Date", "Payable_Date",
                           "Dividend_Type", "Amount", "Currency"]
    assert rows(out, "Symbol", "Ex-Dividend_Date", "Amount", "Currency") == [
        ("P", "2018-01-02", " 0.4", "USD"), ("P", "2019-01-02", "0.5", ""), ("P", "2020-03-01", "0.6", "")]
    win = dividends.dividend_window(out, "2020-01-01", 1)
    assert rows(win, "Ex-Dividend_Date") == [("2019-01-02",), ("2020-03-01",)]
