"""

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables. Dates are shown as ISO text, every computed column has a fixed
name, and the SQL twin of each entry is in ``tickerlake.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.functions import exprs as X
from tickerlake.operators import clean, dividends, history, keys, ledger, sheets
from tickerlake.plans import store_jobs as P
from tickerlake.session import shared_dir
from tickerlake.sources import adapters as A
from tickerlake.sources import offset_csv as CSV
from tickerlake.sources import store as S
from tickerlake.sources.store import Store

DIVIDEND_AS_OF = "2001-08-01"
DIVIDEND_YEARS = 3
REORDERED_COLUMNS = ["Date", "Close", "High", "Low", "Open", "Volume"]
PRICE_FILE_COLUMNS = ["Date", "Open", "High", "Low", "Close", "Volume"]
PRICE_FILE_SCHEMA = "Date STRING, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE, Volume STRING"

Query = Callable[[SparkSession, str], DataFrame]


def _iso(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, X.iso_date(c))
    return df


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def q_incremental_prices(spark, d):
    out = history.incremental_prices(A.prices_stored(spark, d), A.prices_incoming(spark, d))
    return _iso(out, "Reference")


def q_latest_per_key(spark, d):
    return _iso(history.latest_per_key(A.prices_stored(spark, d)), "last_reference")


def q_price_history(spark, d):
    return _iso(clean.price_history(A.prices_raw(spark, d)), "Reference")


def q_price_rejects(spark, d):
    return clean.price_rejects(A.prices_raw(spark, d))


def q_listing_clean(spark, d):
    return clean.listing_clean(A.listing_nasdaq(spark, d), A.listing_nyse(spark, d))


def q_first_per_key(spark, d):
    both = (A.listing_nasdaq(spark, d).withColumn("Market", F.lit("NASDAQ")).withColumn("src", F.lit(0))
            .unionByName(A.listing_nyse(spark, d).withColumn("Market", F.lit("NYSE")).withColumn("src", F.lit(1))))
    both = both.select(X.strip_whitespace("Symbol").alias("Symbol"), "Name", "Market", "src", "pos")
    return clean.first_per_key(both, ["Symbol"], ["src", "pos"]).drop("src")


def q_split_amount(spark, d):
    past = A.dividends_past(spark, d)
    return clean.split_amount(past.select("Symbol", "Ex-Dividend Date", "Amount"), "Amount")


def q_dividend_history(spark, d):
    return dividends.dividend_history(A.dividends_past(spark, d), A.dividends_upcoming(spark, d))


def q_dividend_window(spark, d):
    div = dividends.dividend_history(A.dividends_past(spark, d), A.dividends_upcoming(spark, d))
    return dividends.dividend_window(div, DIVIDEND_AS_OF, DIVIDEND_YEARS)


def q_underscore_columns(spark, d):
    return clean.underscore_columns(A.dividends_past(spark, d))


def q_key_first(spark, d):
    long = A.sheets_long(spark, d)
    symbol_last = long.select(*[c for c in long.columns if c != "Symbol"], "Symbol")
    return clean.key_first(symbol_last)


def q_drop_null_columns(spark, d):
    """A wide report of every period that is named, stored once, without those that hold no value."""
    long = A.sheets_with_ttm(spark, d)
    long = long.where((F.col("report") == "cf") & (F.col("freq") == 12))
    wide = _stored(sheets.annual_cashflow(long, sheets.period_names(long)), "wide-report")
    return clean.drop_null_columns(wide)


def q_drop_null_periods(spark, d):
    return sheets.drop_null_periods(A.sheets_long(spark, d))


def q_format_sheet(spark, d):
    return sheets.format_sheet(A.sheets_long(spark, d), "is", freq=12)


def q_annual_cashflow(spark, d):
    return sheets.annual_cashflow(A.sheets_long(spark, d))


def q_quarterly_cashflow(spark, d):
    return sheets.quarterly_cashflow(A.sheets_long(spark, d))


def q_key_exists(spark, d):
    return history.key_exists(A.keys_db(spark, d), A.prices_stored(spark, d), flag="has_history")


def q_append_new_history(spark, d):
    out = history.append_new_history(A.prices_stored(spark, d), A.prices_incoming(spark, d))
    return _iso(out, "Reference")


def q_rejected_history(spark, d):
    return history.rejected_history(A.prices_stored(spark, d), A.prices_incoming(spark, d))


def q_route_report(spark, d):
    return history.route_report(A.sheets_stored(spark, d), A.sheets_long(spark, d))


def q_route_rejects(spark, d):
    return history.route_rejects(A.sheets_mixed(spark, d))


def q_compare_lists(spark, d):
    return keys.compare_lists(A.keys_db(spark, d), A.keys_new(spark, d))


def q_new_keys(spark, d):
    return keys.new_keys(A.keys_db(spark, d), A.keys_new(spark, d))


def q_new_keys_summary(spark, d):
    return keys.new_keys_summary(A.keys_db(spark, d), A.keys_new(spark, d))


def q_refresh_status(spark, d):
    return history.refresh_status(A.keys_db(spark, d), A.prices_stored(spark, d), A.prices_incoming(spark, d))


def q_rename_map(spark, d):
    return keys.rename_map(A.keys_db(spark, d), A.ticker_changes(spark, d))


def q_rename_keys(spark, d):
    mapping = keys.rename_map(A.keys_db(spark, d), A.ticker_changes(spark, d))
    return _iso(keys.rename_keys(A.prices_stored(spark, d), mapping), "Reference")


def q_rename_audit(spark, d):
    return keys.rename_audit(A.keys_db(spark, d), A.ticker_changes(spark, d)).drop("pos", "Date")


# Written report files: (kind of files) -> how to write them into a folder. Reports per symbol stand in bundles.
FILES: dict[str, Callable[[SparkSession, str, str], str | CSV.Bundles]] = {
    "prices": lambda spark, d, out: CSV.bundle_offset_csv(A.prices_raw(spark, d), out, PRICE_FILE_COLUMNS, "daily history"),
    "reordered": lambda spark, d, out: CSV.bundle_offset_csv(A.prices_raw(spark, d), out, REORDERED_COLUMNS, "daily history"),
    "sheets": lambda spark, d, out: CSV.bundle_sheets(A.sheets_long(spark, d), out),
    "short_sheets": lambda spark, d, out: CSV.bundle_sheets(A.sheets_long(spark, d), out, short=True),
    "nasdaq": lambda spark, d, out: CSV.write_listing(A.listing_nasdaq(spark, d), out),
    "nyse": lambda spark, d, out: CSV.write_listing(A.listing_nyse(spark, d), out),
}
# The files that a query reads.
FILES_OF = {"read_offset_csv": ["prices"], "read_reordered_csv": ["reordered"], "read_sheets": ["sheets"],
            "read_short_sheets": ["short_sheets"], "read_listing": ["nasdaq", "nyse"]}
_written: dict[tuple[str, str, str], str | CSV.Bundles] = {}


def report_files(spark: SparkSession, d: str, kind: str) -> str | CSV.Bundles:
    """Folder (or bundles) of the report files of one kind, written once per session and input."""
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _written:
        _written[key] = FILES[kind](spark, d, shared_dir(spark, f"{kind}-files"))
    return _written[key]


def q_read_offset_csv(spark, d):
    """Every raw price row, from per-symbol report files (in bundles) with a title line above the header."""
    return CSV.read_offset_csv(spark, report_files(spark, d, "prices"), 1, PRICE_FILE_SCHEMA).drop("__order")


def q_read_sheets(spark, d):
    """Every sheet, from one report file (in bundles) per (symbol, report, freq), as long rows."""
    return CSV.read_sheets(spark, report_files(spark, d, "sheets"), 1)


def q_read_reordered_csv(spark, d):
    """Price files whose columns stand in another order: cells go by header name."""
    return CSV.read_offset_csv(spark, report_files(spark, d, "reordered"), 1, PRICE_FILE_SCHEMA).drop("__order")


def q_read_short_sheets(spark, d):
    """Sheet files whose lines end with their last filled cell (section lines hold no comma at all)."""
    return CSV.read_sheets(spark, report_files(spark, d, "short_sheets"), 1)


def q_read_listing(spark, d):
    """Both exchanges' listing files (header on row 1, byte-order mark, quotes), cleaned."""
    nasdaq, nyse = (CSV.read_listing(spark, report_files(spark, d, kind)) for kind in ("nasdaq", "nyse"))
    return clean.listing_clean(nasdaq, nyse)


def q_report_outcomes(spark, d):
    """What became of each sheet and dividend history of every symbol of the key table."""
    div = dividends.dividend_history(A.dividends_past(spark, d), A.dividends_upcoming(spark, d))
    return ledger.report_outcomes(A.keys_db(spark, d), A.sheets_mixed(spark, d), A.sheets_stored(spark, d), div, A.dividends_stored(spark, d))


def q_number_rejects(spark, d):
    """Cells of listings and prices that hold a text, yet no number."""
    listed = ledger.listing_number_rejects(A.messy(A.listing_nasdaq(spark, d)), A.messy(A.listing_nyse(spark, d)))
    return (ledger.price_number_rejects(A.prices_raw(spark, d)).withColumn("source", F.lit("prices"))
            .unionByName(listed.withColumn("source", F.lit("listing"))))


def q_create_key_table(spark, d):
    """The key table after it was created, and after a second attempt with another list, which is refused."""
    store = Store(spark, shared_dir(spark, "store"))
    first, second = (clean.listing_clean(A.listing_nasdaq(spark, d, "S", skip_segment=s), A.listing_nyse(spark, d, "S")) for s in ("AUTOMOBILE", "BUILDING"))
    run = store.run("first")
    P.create_key_table(run, first)
    run.commit()
    try:
        P.create_key_table(store.run("second"), second)
        outcome = "created"
    except ValueError:
        outcome = "already_exists"
    return store.read(S.KEY_TABLE).withColumn("second_attempt", F.lit(outcome))


def q_evolved_dividends(spark, d):
    """Dividends after two appends, of which the second brings the currency as a new column."""
    store = Store(spark, shared_dir(spark, "store"))
    both = dividends.dividend_history(A.dividends_past(spark, d), A.dividends_upcoming(spark, d))
    for name, rows in (("past", clean.underscore_columns(A.dividends_past(spark, d))), ("all", both)):
        run = store.run(name)
        run.append(S.DIVIDENDS, rows)
        run.commit()
    return store.read(S.DIVIDENDS)


def _renamed(spark, d, skip: str | None = None) -> tuple[Store, dict, DataFrame]:
    """Prices, sheets and dividends stored, then renamed where they lie (except ``skip``); with the parts before and after."""
    store = Store(spark, shared_dir(spark, "store"))
    div = dividends.dividend_history(A.dividends_past(spark, d), A.dividends_upcoming(spark, d))
    run = store.run("load")
    for name, rows in ((S.PRICES, A.prices_stored(spark, d)), (S.SHEETS, A.sheets_stored(spark, d)), (S.DIVIDENDS, div)):
        run.append(name, rows)
    run.commit()
    mapping = keys.rename_map(A.keys_db(spark, d), A.ticker_changes(spark, d)).checkpoint(eager=True)
    run = store.run("rename")
    parts = {name: (run.read(name),) * 2 if name == skip else run.rename_symbols(name, mapping, keys.rename_keys) for name in run.names()}
    run.commit()
    return store, parts, mapping


def q_renamed_tables(spark, d):
    """Every stored row of three tables after a rename at rest."""
    store, _, _ = _renamed(spark, d)
    numbers = ["Open", "High", "Low", "Close", "Volume"]
    none = [F.lit(None).cast("double").alias(c) for c in numbers]
    prices = store.read(S.PRICES).select(F.lit(S.PRICES).alias("table"), "Symbol", X.iso_date("Reference").alias("row"), *numbers)
    rows = store.read(S.SHEETS)
    name = F.concat_ws("/", "report", F.col("freq").cast("string"), F.col("pos").cast("string"), "item", "label", "period")
    rows = rows.select(F.lit(S.SHEETS).alias("table"), "Symbol", name.alias("row"), F.col("value").alias("Open"), *none[1:])
    div = store.read(S.DIVIDENDS)
    div = div.select(F.lit(S.DIVIDENDS).alias("table"), "Symbol", F.concat_ws("/", *[c for c in div.columns if c != "Symbol"]).alias("row"), *none)
    return prices.unionByName(rows).unionByName(div)


def q_renames_done(spark, d):
    """Verdict per table over the rename messages of a run that left one table as it was."""
    _, parts, mapping = _renamed(spark, d, skip=S.DIVIDENDS)
    known, changes = A.keys_db(spark, d), A.ticker_changes(spark, d)
    applied = None
    for name, (before, after) in parts.items():
        done = keys.applied_renames(known, changes, mapping, name, before, after)
        applied = done if applied is None else applied.unionByName(done)
    return keys.renames_done(keys.rename_audit(known, changes, list(parts)), applied, by=["table"])


def _initial(spark, d) -> tuple[Store, P.Inputs]:
    store = Store(spark, shared_dir(spark, "store"))
    return store, P.Inputs(nasdaq=A.listing_nasdaq(spark, d, "S", skip_segment="AUTOMOBILE"),
                           nyse=A.listing_nyse(spark, d, "S"),
                           prices=A.prices_stored_raw(spark, d), sheets=A.sheets_stored(spark, d),
                           div_past=A.dividends_past(spark, d), div_upcoming=A.dividends_upcoming(spark, d))


def _daily(spark, d) -> P.Inputs:
    return P.Inputs(nasdaq=A.listing_nasdaq(spark, d, "S", skip_segment="BUILDING"),
                    nyse=A.listing_nyse(spark, d, "S"), prices=A.prices_download(spark, d),
                    sheets=A.sheets_mixed(spark, d), div_past=A.dividends_past(spark, d),
                    div_upcoming=A.dividends_upcoming(spark, d), changes=A.ticker_changes(spark, d))


def q_initialize(spark, d):
    """Initial load into a fresh store; returns the run's status rows."""
    store, inputs = _initial(spark, d)
    return P.initialize(spark, inputs, store).drop("run_id")


def q_daily_update(spark, d):
    """Initial load of all tables, then one daily update (renames, new listing,
    full re-download); returns the daily run's status rows."""
    store, inputs = _initial(spark, d)
    P.initialize(spark, inputs, store)
    return P.daily_update(spark, _daily(spark, d), store).drop("run_id")


def q_daily_tables(spark, d):
    """The stored tables after the initial load and one daily update, summed per table and symbol."""
    store, inputs = _initial(spark, d)
    P.initialize(spark, inputs, store)
    P.daily_update(spark, _daily(spark, d), store)
    last = {S.PRICES: X.iso_date("Reference"), S.LATEST: X.iso_date("last_reference"), S.SHEETS: F.col("period"),
            S.DIVIDENDS: F.col("`Ex-Dividend_Date`"), S.KEY_TABLE: F.col("Market")}
    out = None
    for name, col in last.items():
        part = store.read(name).groupBy("Symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.max(col).alias("last"))
        part = part.select(F.lit(name).alias("table"), "Symbol", "n_rows", "last")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES: dict[str, Query] = {
    "incremental_prices": q_incremental_prices,
    "latest_per_key": q_latest_per_key,
    "price_history": q_price_history,
    "price_rejects": q_price_rejects,
    "listing_clean": q_listing_clean,
    "first_per_key": q_first_per_key,
    "split_amount": q_split_amount,
    "dividend_history": q_dividend_history,
    "dividend_window": q_dividend_window,
    "underscore_columns": q_underscore_columns,
    "key_first": q_key_first,
    "drop_null_columns": q_drop_null_columns,
    "drop_null_periods": q_drop_null_periods,
    "format_sheet": q_format_sheet,
    "annual_cashflow": q_annual_cashflow,
    "quarterly_cashflow": q_quarterly_cashflow,
    "key_exists": q_key_exists,
    "append_new_history": q_append_new_history,
    "rejected_history": q_rejected_history,
    "route_report": q_route_report,
    "route_rejects": q_route_rejects,
    "compare_lists": q_compare_lists,
    "new_keys": q_new_keys,
    "new_keys_summary": q_new_keys_summary,
    "refresh_status": q_refresh_status,
    "rename_map": q_rename_map,
    "rename_keys": q_rename_keys,
    "rename_audit": q_rename_audit,
    "read_offset_csv": q_read_offset_csv,
    "read_sheets": q_read_sheets,
    "read_reordered_csv": q_read_reordered_csv,
    "read_short_sheets": q_read_short_sheets,
    "read_listing": q_read_listing,
    "report_outcomes": q_report_outcomes,
    "number_rejects": q_number_rejects,
    "create_key_table": q_create_key_table,
    "evolved_dividends": q_evolved_dividends,
    "renamed_tables": q_renamed_tables,
    "renames_done": q_renames_done,
    "initialize": q_initialize,
    "daily_update": q_daily_update,
    "daily_tables": q_daily_tables,
}
