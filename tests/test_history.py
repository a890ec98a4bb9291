import datetime as dt

from helpers import rows
from tickerlake.operators import history

D = dt.date
PRICE = "Symbol string, Reference date, Close double"


def _hist(spark):
    return spark.createDataFrame([("UP", D(2020, 1, 2), 1.0), ("UP", D(2020, 1, 3), 1.0),
                                  ("NEWROWS", D(2020, 1, 1), 1.0), ("QUIET", D(2020, 1, 5), 1.0)], PRICE)


def _incoming(spark):
    return spark.createDataFrame([("UP", D(2020, 1, 2), 2.0), ("UP", D(2020, 1, 3), 2.0),
                                  ("NEWROWS", D(2020, 1, 1), 2.0), ("NEWROWS", D(2020, 1, 2), 2.0),
                                  ("NEWROWS", D(2020, 1, 3), 2.0), ("NOHIST", D(2020, 1, 9), 2.0)], PRICE)


def test_latest_and_incremental(spark):
    assert rows(history.latest_per_key(_hist(spark))) == [
        ("NEWROWS", D(2020, 1, 1)), ("QUIET", D(2020, 1, 5)), ("UP", D(2020, 1, 3))]
    got = rows(history.incremental_prices(_hist(spark), _incoming(spark)), "Symbol", "Reference")
    assert got == [("NEWROWS", D(2020, 1, 2)), ("NEWROWS", D(2020, 1, 3))]


def test_incremental_is_idempotent_after_append(spark):
    h, inc = _hist(spark), _incoming(spark)
    new = history.incremental_prices(h, inc)
    assert history.incremental_prices(h.unionByName(new), inc).count() == 0


def test_latest_table_matches_recomputed(spark):
    h, inc = _hist(spark), _incoming(spark)
    new = history.incremental_prices(h, inc)
    advanced = history.advance_latest(history.latest_per_key(h), new)
    assert rows(advanced) == rows(history.latest_per_key(h.unionByName(new)))


def test_refresh_status(spark):
    req = spark.createDataFrame([("UP",), ("NEWROWS",), ("QUIET",), ("NOHIST",), (None,)], "Symbol string")
    got = rows(history.refresh_status(req, _hist(spark), _incoming(spark)))
    assert got == [("NEWROWS", "committed", 2), ("NOHIST", "not_in_history", 0),
                   ("QUIET", "no_price_history", 0), ("UP", "already_latest", 0)]


def test_key_exists_append_and_reject(spark):
    req = spark.createDataFrame([("UP",), ("NOHIST",), (None,)], "Symbol string")
    assert rows(history.key_exists(req, _hist(spark))) == [(None, False), ("NOHIST", False), ("UP", True)]
    appended = history.append_new_history(_hist(spark), _incoming(spark))
    assert rows(appended, "Symbol") == [("NOHIST",)]
    rejected = history.rejected_history(_hist(spark), _incoming(spark))
    assert rows(rejected, "Symbol", "n_rows") == [("NEWROWS", 3), ("UP", 2)]


def test_route_report(spark):
    schema = "Symbol string, report string, freq int, pos long, item string, period string, value double"
    stored = spark.createDataFrame([("A", "cf", 12, 1, "x", "2020", 1.0)], schema)
    inc = spark.createDataFrame([("A", "cf", 12, 1, "x", "2021", 1.0), ("A", "cf", 3, 1, "x", "2021-Q1", 1.0),
                                 ("B", "is", 12, 1, "x", "2021", 1.0), ("B", "zz", 12, 1, "x", "2021", 1.0),
                                 ("B", "bs", 6, 1, "x", "2021", 1.0)], schema)
    got = rows(history.route_report(stored, inc), "Symbol", "table")
    assert got == [("A", "TenQCashflow"), ("B", "TenKIncome")]
    assert rows(history.route_rejects(inc), "Symbol", "report", "freq", "n_rows") == [("B", "bs", 6, 1), ("B", "zz", 12, 1)]
