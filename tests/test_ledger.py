import datetime as dt

from helpers import rows
from tickerlake.operators import keys, ledger

RAW = "Symbol string, Date string, Open string, High double, Low double, Close double, Volume string"


def _scope(spark):
    old = spark.createDataFrame([("OLD",), ("UNMARKED",), ("QUIET",), (None,)], "Symbol string")
    new = spark.createDataFrame([("NEW",), ("NEW",), ("SEEN",), ("SILENT",)], "Symbol string")
    latest = spark.createDataFrame([("OLD", dt.date(2020, 1, 5)), ("OLD", dt.date(2020, 1, 3)), ("SEEN", dt.date(2020, 1, 1)),
                                    ("QUIET", dt.date(2020, 1, 9))], "Symbol string, last_reference date")
    return ledger.scope(old, new, latest)


def _download(spark):
    r = lambda s, day, o="1", v="10": (s, day, o, 1.0, 1.0, 1.0, v)
    return spark.createDataFrame([
        r("OLD", "1/5/2020"), r("OLD", "1/6/2020"), r("OLD", "1/6/2020"), r("OLD", "01/07/2020", "x", "???"), r("OLD", "13/45/2020"), r("OLD", None),
        r("UNMARKED", "1/6/2020"), r("QUIET", "1/9/2020"), r("NEW", "1/2/2020", "", None), r("NEW", "1/2/2020", "n/a", ""), r("SEEN", "1/2/2020"),
        r("SILENT", "bad"), r("UNLISTED", "1/6/2020"), r(None, "1/6/2020")], RAW).repartition(3)


def test_tags_of_downloaded_rows(spark):
    tagged = ledger.tag_prices(_download(spark), _scope(spark))
    got = sorted((r["Symbol"], r["tag"], r["bad_cells"]) for r in tagged.collect())
    assert got == sorted([("OLD", "known", 0), ("OLD", "newer", 0), ("OLD", "newer", 0), ("OLD", "newer", 17), ("OLD", "bad_date", 0), ("OLD", "bad_date", 0),
                          ("UNMARKED", "no_mark", 0), ("QUIET", "known", 0), ("NEW", "brand_new", 0), ("NEW", "brand_new", 0), ("SEEN", "refused", 0),
                          ("SILENT", "bad_date", 0)])


def test_folding_keeps_equal_rows_and_counts_the_rest(spark):
    tagged = ledger.tag_prices(_download(spark), _scope(spark))
    folded = ledger.folded(tagged)
    assert folded.where("tag not in ('newer', 'brand_new')").where("Reference is not null or Close is not null").count() == 0
    again = ledger.unfolded(folded)
    kept = ["Symbol", "Reference", "Open", "High", "Low", "Close", "Volume", "bad_cells"]
    assert rows(again.where("tag in ('newer', 'brand_new')"), *kept) == rows(tagged.where("tag in ('newer', 'brand_new')"), *kept)
    assert rows(ledger.tag_counts(again)) == rows(ledger.tag_counts(tagged.selectExpr("*", "1L as n_rows")))
    # One pass: a single scan, and the rows that are not kept fold before they move.
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_price_outcomes_and_cell_counts(spark):
    scope = _scope(spark)
    again = ledger.unfolded(ledger.folded(ledger.tag_prices(_download(spark), scope)))
    got = {r["Symbol"]: (r["is_new"], r["status"], r["n_rows"]) for r in ledger.price_outcomes(scope, ledger.tag_counts(again)).collect()}
    assert got == {"OLD": (False, "committed", 3), "UNMARKED": (False, "not_in_history", 0), "QUIET": (False, "already_latest", 0),
                   "NEW": (True, "committed", 2), "SEEN": (True, "already_present", 0), "SILENT": (True, "no_price_history", 0)}
    cells = ledger.cell_counts(again.where("tag in ('newer', 'brand_new')"), again["n_rows"])
    assert rows(cells) == [("OLD", "Open", 1), ("OLD", "Volume", 1)]
    assert ledger.tag_prices(_download(spark).limit(0), scope).count() == 0


def test_number_rejects_of_listings(spark):
    kinds = "Symbol string, LastSale string, MarketCap string"
    a = spark.createDataFrame([("A ", "call", "$1M"), ("B", "n/a", "$1.5K"), ("C", "1d", "n/a"), ("D", None, None), (None, "x", "x")], kinds)
    b = spark.createDataFrame([("A", "?", "$x")], kinds)
    assert rows(ledger.listing_number_rejects(a, b)) == [("A", "LastSale", 2), ("A", "MarketCap", 1), ("B", "MarketCap", 1)]


def test_report_outcomes(spark):
    kinds = "Symbol string, report string, freq int, period string, value double"
    cells = spark.createDataFrame([
        ("A", "cf", 12, "2019", 1.0), ("A", "cf", 12, "2020", None), ("A", "cf", 12, "2019", None), ("A", "is", 3, "Q1", None), ("A", "bs", 3, "Q1", 1.0),
        ("A", "zz", 12, "2019", 1.0), ("A", "cf", None, "2019", 1.0), ("OTHER", "cf", 12, "2019", 1.0), ("C", "bs", 3, "Q1", 1.0)], kinds)
    stored = spark.createDataFrame([("A", "bs", 3), ("B", "cf", 3)], "Symbol string, report string, freq int")
    asked = spark.createDataFrame([("A",), ("A",), ("B",), ("C",), (None,)], "Symbol string")
    div = spark.createDataFrame([("A",), ("A",), ("C",)], "Symbol string")
    out = ledger.report_outcomes(asked, cells, stored, div, spark.createDataFrame([("C",)], "Symbol string"))
    got = {(r["Symbol"], r["report"], r["freq"]): (r["outcome"], r["n_rows"]) for r in out.collect()}
    assert len(got) == 3 * 7 + 2
    assert got[("A", "cf", 12)] == ("committed", 2) and got[("A", "is", 3)] == ("empty_report", 0) and got[("A", "bs", 3)] == ("already_present", 0)
    assert got[("A", "zz", 12)] == ("unknown_report", 1) and got[("A", "cf", None)] == ("unknown_report", 1)
    assert got[("B", "cf", 3)] == ("no_report", 0)           # nothing came, whatever is stored
    assert got[("A", "div", None)] == ("committed", 2) and got[("B", "div", None)] == ("no_dividend_history", 0)
    assert got[("C", "div", None)] == ("already_present", 0) and got[("C", "bs", 3)] == ("committed", 1)


def _changes(spark):
    known = spark.createDataFrame([("A",), ("B",), ("X",)], "Symbol string")
    changes = spark.createDataFrame([(1, "A", "B", "d"), (2, "B", "C", "d"), (3, "X", "Y", "d"), (4, "NOT", "Z", "d")], "pos int, Old string, New string, Date string")
    return known, changes, keys.rename_map(known, changes)


def test_verdict_over_rename_messages(spark):
    known, changes, mapping = _changes(spark)
    table = spark.createDataFrame([("A", 1), ("A", 2), ("Q", 3)], "Symbol string, v int")
    other = spark.createDataFrame([("B", 1), ("X", 2)], "Symbol string, v int")
    audit = keys.rename_audit(known, changes, ["good", "bad"])
    applied = keys.applied_renames(known, changes, mapping, "good", table, keys.rename_keys(table, mapping))
    applied = applied.unionByName(keys.applied_renames(known, changes, mapping, "bad", other, other.where("v = 2")))
    assert rows(keys.renames_done(audit, applied, ["table"])) == [("bad", 3, 1, False), ("good", 3, 3, True)]
    assert rows(keys.renames_done(audit, applied)) == [(6, 4, False)]
    assert rows(keys.renames_done(audit.limit(0), applied)) == [(0, 0, True)]


def test_a_symbol_renamed_onto_an_old_one_is_no_failure(spark):
    known = spark.createDataFrame([("A",), ("B",)], "Symbol string")
    changes = spark.createDataFrame([(1, "B", "C", "d"), (2, "A", "B", "d")], "pos int, Old string, New string, Date string")
    mapping = keys.rename_map(known, changes)
    table = spark.createDataFrame([("A", 1), ("B", 2)], "Symbol string, v int")
    done = keys.renames_done(keys.rename_audit(known, changes, ["t"]),
                             keys.applied_renames(known, changes, mapping, "t", table, keys.rename_keys(table, mapping)))
    assert rows(done) == [(2, 2, True)]
