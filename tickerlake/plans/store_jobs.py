"""The two end-to-end jobs: initialise the store, and the daily update.

Both work on all symbols at once: every step is one DataFrame job per table,
never a loop over symbols. Inputs are DataFrames (see ``sources`` for reading
report files); outputs are tables in a ``Store`` plus one status row per
(step, symbol) in the ``Status`` table, which are returned. A job's tables become
visible together; repeating a run id after a stop gives what an uninterrupted
run gives, and repeating a committed one changes nothing.

A price download is read once: its rows are tagged, those to store go straight into
their table and the rest is counted in the same pass; marks, outcomes and rejects
come from the few columns written. Every listed symbol gets an outcome for its prices,
each of its sheets and its dividends, also where there was nothing to store.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickerlake.operators import clean, dividends, history, keys, ledger, sheets
from tickerlake.session import checkpoint_root
from tickerlake.sources import store as S

# The verdict over all rename messages of a run.
ALL_RENAMED, RENAMES_MISSING = "all_renamed", "renames_missing"
# Columns of the written price rows that are counted.
COUNTED = ["tag", "bad_cells", "n_rows"]
# Tables that every run adds a folder to.
GROWING = (S.KEY_TABLE, S.PRICES, S.SHEETS, S.DIVIDENDS, S.STATUS)


@dataclass
class Inputs:
    """Raw inputs of one run. Any of them may be None (that step is skipped)."""
    nasdaq: DataFrame | None = None          # raw listing rows (with a ``pos`` column)
    nyse: DataFrame | None = None
    prices: DataFrame | None = None          # raw price rows (Symbol, Date, OHLC, Volume)
    sheets: DataFrame | None = None          # long sheet rows
    div_past: DataFrame | None = None
    div_upcoming: DataFrame | None = None
    changes: DataFrame | None = None         # ticker changes (pos, Old, New, Date)


def _status(job: str, step: str, df: DataFrame, status, n_rows) -> DataFrame:
    return df.select(F.lit(job).alias("job"), F.lit(step).alias("step"),
                     F.col("Symbol").cast("string").alias("Symbol"),
                     (F.lit(status) if isinstance(status, str) else status).alias("status"),
                     n_rows.cast("long").alias("n_rows"))


def _finish(run: S.Run, rows: list[DataFrame]) -> DataFrame:
    """Store the status rows, publish the run and return its rows."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    run.append(S.STATUS, out.withColumn("run_id", F.lit(run.run_id)).withColumn("run_ts", F.current_timestamp()))
    for name in GROWING:
        run.compact(name)
    run.commit()
    return _report(run)


def _report(run: S.Run) -> DataFrame:
    return run.read(S.STATUS).where(F.col("run_id") == run.run_id).drop("run_ts")


def _merge_marks(latest: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rename high-water marks; a symbol renamed onto an existing one keeps the
    later of the two dates (one row per symbol, as the marks require)."""
    renamed = keys.rename_keys(latest, mapping)
    return renamed.groupBy("Symbol").agg(F.max("last_reference").alias("last_reference"))


def _listed(df: DataFrame, symbols: DataFrame) -> DataFrame:
    return df.join(symbols.select("Symbol").distinct(), "Symbol", "left_semi")


def _price_log(job: str, symbols: DataFrame, written: DataFrame) -> list[DataFrame]:
    """Outcome of every listed symbol, rows with a bad date and cells that are no number, from the written rows' counts."""
    counts = ledger.tag_counts(written)
    outcomes = ledger.price_outcomes(symbols, counts)
    bad = counts.where(F.col(f"n_{ledger.BAD_DATE}") > 0)
    cells = ledger.cell_counts(written.where(F.col("tag").isin(*ledger.KEPT)), F.col("n_rows"))
    return [_status(job, "prices", outcomes.where("not is_new"), F.col("status"), F.col("n_rows")),
            _status(job, "new_prices", outcomes.where("is_new"), F.col("status"), F.col("n_rows")),
            _status(job, "price_rejects", bad, ledger.BAD_DATE, F.col(f"n_{ledger.BAD_DATE}")),
            _status(job, "number_rejects", cells, F.col("column"), F.col("n_cells"))]


def _sheet_status() -> Column:
    kind = F.concat_ws("/", F.coalesce("report", F.lit("?")), F.coalesce(F.col("freq").cast("string"), F.lit("?")))
    return F.concat_ws(" ", F.col("outcome"), kind)


def _reports(run: S.Run, job: str, inputs: Inputs, symbols: DataFrame, log: list[DataFrame]) -> None:
    """Sheets and dividends of ``symbols`` that the store does not hold yet; an outcome for each report of each symbol."""
    if inputs.sheets is not None:
        rows, stored = _listed(inputs.sheets, symbols), run.read_or_empty(S.SHEETS)
        outcomes = ledger.sheet_outcomes(symbols, rows, stored)
        run.append(S.SHEETS, history.route_report(stored, sheets.drop_null_periods(rows)).drop("table"))
        odd = F.col("outcome") == history.UNKNOWN_REPORT
        log.append(_status(job, "sheets", outcomes.where(~odd), _sheet_status(), F.col("n_rows")))
        log.append(_status(job, "sheet_rejects", outcomes.where(odd), _sheet_status(), F.col("n_rows")))
    if inputs.div_past is not None:
        upcoming = inputs.div_upcoming if inputs.div_upcoming is not None else inputs.div_past.limit(0)
        div = _listed(dividends.dividend_history(inputs.div_past, upcoming), symbols)
        stored = run.read(S.DIVIDENDS) if run.exists(S.DIVIDENDS) else None
        outcomes = ledger.dividend_outcomes(symbols, div, stored)
        run.append(S.DIVIDENDS, div if stored is None else history.append_new_history(stored, div))
        log.append(_status(job, "dividends", outcomes, F.col("outcome"), F.col("n_rows")))


def _rename(run: S.Run, job: str, changes: DataFrame) -> list[DataFrame]:
    """Rename every stored table; the messages of the changes found done, and the verdict over all of them."""
    key_before = run.read(S.KEY_TABLE)
    mapping = keys.rename_map(key_before, changes).checkpoint(eager=True)
    tables, applied = [t for t in run.names() if t != S.STATUS], None
    for name in tables:
        before, after = run.rename_symbols(name, mapping, _merge_marks if name == S.LATEST else keys.rename_keys)
        done = keys.applied_renames(key_before, changes, mapping, name, before, after)
        applied = done if applied is None else applied.unionByName(done)
    audit = keys.rename_audit(key_before, changes, tables)
    reported = audit.join(applied.select("message").distinct(), "message", "left_semi")
    verdict = keys.renames_done(audit, applied).withColumn("Symbol", F.lit(None).cast("string"))
    return [_status(job, "rename", reported.withColumn("Symbol", F.col("Old")), F.col("message"), F.lit(1)),
            _status(job, "rename_verdict", verdict, F.when(F.col("all_renamed"), ALL_RENAMED).otherwise(RENAMES_MISSING), F.col("n_expected"))]


def create_key_table(run: S.Run, symbols: DataFrame) -> DataFrame:
    """Create the symbol key table (Symbol, Market); an existing one is an error."""
    if run.exists(S.KEY_TABLE):
        raise ValueError(f"the {S.KEY_TABLE} key table already exists")
    return run.replace(S.KEY_TABLE, symbols)


def _run_id(job: str, run_id: str | None) -> str:
    return run_id or f"{job}-{uuid.uuid4().hex[:12]}"


def initialize(spark: SparkSession, inputs: Inputs, store: S.Store, run_id: str | None = None) -> DataFrame:
    """Listing -> key table -> price history, sheets, dividends of listed symbols -> status log."""
    checkpoint_root(spark)
    job, log = "initialize", []
    run = store.run(_run_id(job, run_id))
    if run.done:
        return _report(run)
    key_table = create_key_table(run, clean.listing_clean(inputs.nasdaq, inputs.nyse))
    log.append(_status(job, "key_table", key_table, "created", F.lit(1)))

    if inputs.prices is not None:
        # Nearly every row is kept: tagged rows go to their buckets as they are, rejected ones aside.
        symbols = ledger.scope(key_table.limit(0), key_table, run.read_or_empty(S.LATEST))
        tagged = ledger.tag_prices(inputs.prices, symbols).withColumn("n_rows", F.lit(1).cast("long"))
        rows, written = run.append_counted(S.PRICES, tagged, ~F.col("tag").isin(*ledger.KEPT), COUNTED)
        run.replace(S.LATEST, history.latest_per_key(rows))
        log += _price_log(job, symbols, written)
    _reports(run, job, inputs, key_table, log)
    return _finish(run, log)


def daily_update(spark: SparkSession, inputs: Inputs, store: S.Store, run_id: str | None = None) -> DataFrame:
    """Current listing -> ticker renames -> compare lists -> incremental prices
    for listed symbols -> new keys -> history, sheets and dividends of new symbols -> status log."""
    checkpoint_root(spark)
    job, log = "daily_update", []
    run = store.run(_run_id(job, run_id))
    if run.done:
        return _report(run)
    listing = clean.listing_clean(inputs.nasdaq, inputs.nyse).select("Symbol", "Market")

    if inputs.changes is not None:
        log += _rename(run, job, inputs.changes)

    key_table = run.read(S.KEY_TABLE)
    split = keys.compare_lists(key_table, listing).checkpoint(eager=True)  # keys only: one small row per symbol
    log.append(_status(job, "compare", split, F.col("category"), F.lit(1)))
    old = split.where(F.col("category") == keys.OLD)
    new = split.where(F.col("category") == keys.NEW).select("Symbol", "Market")

    if inputs.prices is not None:
        # The history itself is never scanned: marks come from the one-row-per-symbol LatestPrice table. The
        # download is scanned once; only its newer rows are shuffled and written, the rest as counts.
        latest = run.read_or_empty(S.LATEST)
        symbols = ledger.scope(old, new, latest).checkpoint(eager=True)  # one small row per symbol
        tagged = ledger.unfolded(ledger.folded(ledger.tag_prices(inputs.prices, symbols)))
        rows, written = run.append_counted(S.PRICES, tagged, ~F.col("tag").isin(*ledger.KEPT), COUNTED)
        run.replace(S.LATEST, history.advance_latest(latest, rows))
        log += _price_log(job, symbols, written)

    added = keys.new_keys(key_table, new)
    summary = keys.new_keys_summary(key_table, new).first()
    added = run.append(S.KEY_TABLE, added)
    log.append(_status(job, "new_keys", added, summary["message"], F.lit(1)))
    _reports(run, job, inputs, added, log)
    return _finish(run, log)
