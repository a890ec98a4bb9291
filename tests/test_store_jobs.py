import datetime as dt

import pytest

from tickerlake.plans import store_jobs as P
from tickerlake.session import shared_dir
from tickerlake.sources import store as S
from tickerlake.sources.store import Store

LISTING = "Symbol string, Name string, LastSale string, MarketCap string, industry string, pos long"
RAW = "Symbol string, Date string, Open double, High double, Low double, Close double, Volume string"


def _listing(spark, symbols):
    return spark.createDataFrame([(s, s.lower(), "1.0", "$1M", "x", i) for i, s in enumerate(symbols)], LISTING)


def _by_step(status):
    """(step, Symbol) -> (status, n_rows); a symbol has one status per step."""
    found = [((r.step, r.Symbol), (r.status, r.n_rows)) for r in status.collect() if r.step not in ("rename", "sheets", "sheet_rejects")]
    assert len(dict(found)) == len(found)
    return dict(found)


def test_initialize_then_daily(spark):
    store = Store(spark, shared_dir(spark, "test-store"))
    init = P.Inputs(
        nasdaq=_listing(spark, ["A", "B", "C"]), nyse=_listing(spark, ["D"]),
        prices=spark.createDataFrame([("A", "1/2/2020", 1.0, 1.0, 1.0, 1.0, "10"), ("B", "1/2/2020", 1.0, 1.0, 1.0, 1.0, "10"),
                                      ("D", "1/3/2020", 1.0, 1.0, 1.0, 1.0, "10"), ("Z", "1/3/2020", 1.0, 1.0, 1.0, 1.0, "1")], RAW))
    status = P.initialize(spark, init, store)
    by_step = _by_step(status)
    assert by_step[("new_prices", "A")] == ("committed", 1)
    assert by_step[("new_prices", "C")] == ("no_price_history", 0)   # listed, nothing downloaded
    assert ("new_prices", "Z") not in by_step      # not in the key table
    with pytest.raises(ValueError, match="already exists"):
        P.initialize(spark, init, store)

    daily = P.Inputs(
        nasdaq=_listing(spark, ["A", "B", "E"]), nyse=_listing(spark, ["DD"]),
        prices=spark.createDataFrame([("A", "1/2/2020", 1.0, 1.0, 1.0, 1.0, "10"), ("A", "1/5/2020", 2.0, 2.0, 2.0, 2.0, "11"),
                                      ("B", "1/2/2020", 1.0, 1.0, 1.0, 1.0, "10"), ("E", "1/9/2020", 3.0, 3.0, 3.0, 3.0, "5")], RAW),
        changes=spark.createDataFrame([(1, "D", "DD", "2020-01-04")], "pos int, Old string, New string, Date string"))
    status = P.daily_update(spark, daily, store)
    got = _by_step(status)
    assert got[("new_prices", "E")] == ("committed", 1)
    assert got[("compare", "E")][0] == "new" and got[("compare", "C")][0] == "removed"
    assert got[("compare", "DD")][0] == "old"               # renamed D -> DD before the comparison
    assert got[("prices", "DD")] == ("no_price_history", 0)
    assert got[("prices", "A")] == ("committed", 1)         # one row newer than 2020-01-02
    assert got[("prices", "B")] == ("already_latest", 0)
    prices = store.read(S.PRICES)
    assert prices.where("Symbol = 'DD'").count() == 1 and prices.where("Symbol = 'D'").count() == 0
    assert prices.where("Symbol = 'E'").count() == 1        # new listing's history appended
    assert {r.Symbol for r in store.read(S.KEY_TABLE).collect()} == {"A", "B", "C", "DD", "E"}
    assert prices.count() == 5                               # A x2, B, DD, E: nothing lost or doubled
    latest = {r.Symbol: r.last_reference for r in store.read(S.LATEST).collect()}
    assert latest["A"] == dt.date(2020, 1, 5) and latest["DD"] == dt.date(2020, 1, 3)


def test_bucketed_rename_touches_only_its_buckets(spark):
    from pyspark.sql import functions as F
    from tickerlake.operators import keys
    store = Store(spark, shared_dir(spark, "test-buckets"), buckets={S.PRICES: 16})
    prices = spark.range(2000).select(F.concat(F.lit("S"), (F.col("id") % 200).cast("string")).alias("Symbol"),
                                      F.make_date(F.lit(2020), F.lit(1), (F.col("id") % 28 + 1).cast("int"))
                                      .alias("Reference"), *[F.col("id").cast("double").alias(c) for c in ("Open", "High", "Low", "Close", "Volume")])
    run = store.run("r1")
    run.append(S.PRICES, prices)
    run.commit()
    before = {r.Symbol: r["count"] for r in store.read(S.PRICES).groupBy("Symbol").count().collect()}
    mapping = spark.createDataFrame([("S1", "S1000"), ("S2", "S3")], "Old string, New string")
    run = store.run("r2")
    run.rename_symbols(S.PRICES, mapping.limit(0), keys.rename_keys)
    assert run.writes == 0                                   # an empty map writes nothing
    run.rename_symbols(S.PRICES, mapping, keys.rename_keys)
    run.commit()
    old, new = run.entries[S.PRICES]
    assert len(new["buckets"]) <= 4 and not set(old["buckets"]) & set(new["buckets"])
    after = {r.Symbol: r["count"] for r in store.read(S.PRICES).groupBy("Symbol").count().collect()}
    assert "S1" not in after and "S2" not in after
    assert after["S1000"] == before["S1"] and after["S3"] == before["S2"] + before["S3"]
    assert sum(after.values()) == 2000
    run = store.run("r3")
    assert run.compact(S.PRICES) == 0 and run.writes == 0    # too few folders
    assert run.compact(S.PRICES, most=2) > 0
    run.commit()
    assert len(run.entries[S.PRICES]) == 1 and store.read(S.PRICES).count() == 2000
    assert len(store.sweep()) == 2 and store.read(S.PRICES).count() == 2000


def test_many_daily_runs_leave_few_folders_and_rewrite_little(spark, monkeypatch):
    """A large load, then 100 small runs: the load is never rewritten, paths stay few, each small byte is copied a few times."""
    monkeypatch.setattr(S, "LEAST_FOLDER_BYTES", 4000)
    store = Store(spark, shared_dir(spark, "test-upkeep"), buckets={S.PRICES: 2})
    rows = lambda n, day: spark.range(n).selectExpr("concat('S', id % 9) as Symbol", f"date '2020-01-01' + {day} as Reference",
                                                    *[f"cast(id * {day + 1} as double) as {c}" for c in ("Open", "High", "Low", "Close", "Volume")])
    run = store.run("load")
    run.append(S.PRICES, rows(30_000, 0).coalesce(1))
    run.commit()
    load, added, rewritten = run.entries[S.PRICES][0], 0, 0
    for day in range(1, 101):
        run = store.run(f"d{day}")
        run.append(S.PRICES, rows(20, day).coalesce(1))
        added += run.entries[S.PRICES][-1]["bytes"]
        rewritten += run.compact(S.PRICES)
        run.commit()
        assert len(run.entries[S.PRICES]) <= 4 * S.FOLDERS_PER_MERGE
    assert load in run.entries[S.PRICES] and rewritten < 4 * added
    assert store.read(S.PRICES).count() == 30_000 + 100 * 20
    assert store.read(S.PRICES).where("Reference > date '2020-01-01'").groupBy("Reference").count().where("count = 20").count() == 100


def test_schema_evolving_append_and_tables(spark):
    store = Store(spark, shared_dir(spark, "test-evolve"))
    for k, df in enumerate([spark.createDataFrame([("A", "0.5")], "Symbol string, Amount string"),
                            spark.createDataFrame([("B", "0.7", "USD")], "Symbol string, Amount string, Currency string")]):
        run = store.run(f"r{k}")
        run.append(S.DIVIDENDS, df)
        assert len(store.tables()) == min(k, 1)              # nothing shows before the commit
        run.commit()
    got = sorted(tuple(r) for r in store.read(S.DIVIDENDS).select("Symbol", "Amount", "Currency").collect())
    assert got == [("A", "0.5", None), ("B", "0.7", "USD")]
    assert "mergeSchema" not in str(store.view().schemas) and store.view().schema(S.DIVIDENDS).names == ["Symbol", "Amount", "Currency"]
    with pytest.raises(ValueError, match="another type"):
        store.run("r9").append(S.DIVIDENDS, spark.createDataFrame([("A", 0.5)], "Symbol string, Amount double"))
    assert store.tables() == [S.DIVIDENDS] and store.exists(S.DIVIDENDS) and not store.exists(S.PRICES)


SHEET = "Symbol string, report string, freq int, pos long, item string, label string, period string, value double"
DIV = "Symbol string, `Ex-Dividend Date` string, Amount string"


def _days(spark):
    """Inputs of an initial load and of a daily update that touch every table."""
    p = lambda s, day, v: (s, day, v, v, v, v, "10")
    sheet = lambda s, r, f: (s, r, f, 1, "x", "Fiscal year", "2019", 1.0)
    init = P.Inputs(
        nasdaq=_listing(spark, ["A", "B", "C"]), nyse=_listing(spark, ["D"]),
        prices=spark.createDataFrame([p("A", "1/2/2020", 1.0), p("B", "1/2/2020", 1.0), p("D", "1/3/2020", 1.0), p("A", "13/45/2020", 1.0),
                                      p("UNLISTED", "1/2/2020", 1.0)], RAW),
        sheets=spark.createDataFrame([sheet("A", "cf", 12), sheet("D", "is", 3), sheet("B", "zz", 12), sheet("UNLISTED", "cf", 12)], SHEET),
        div_past=spark.createDataFrame([("D", "2019-01-02", "$1"), ("UNLISTED", "2019-01-02", "$1")], DIV))
    daily = P.Inputs(
        nasdaq=_listing(spark, ["A", "B", "E"]), nyse=_listing(spark, ["DD"]),
        prices=spark.createDataFrame([p("A", "1/2/2020", 1.0), p("A", "1/5/2020", 2.0), p("B", "1/2/2020", 1.0), p("E", "1/9/2020", 3.0),
                                      p("E", "x", 3.0)], RAW),
        sheets=spark.createDataFrame([sheet("E", "bs", 3), sheet("E", "cf", 6), sheet("A", "bs", 3)], SHEET),
        div_past=spark.createDataFrame([("E", "2020-01-02", "$2"), ("A", "2020-01-02", "$2")], DIV),
        changes=spark.createDataFrame([(1, "D", "DD", "2020-01-04")], "pos int, Old string, New string, Date string"))
    return init, daily


def _content(store):
    return {t: sorted(map(str, store.read(t).drop("run_ts").collect())) for t in store.tables()}


def test_reports_rejects_and_unlisted_symbols(spark):
    init, daily = _days(spark)
    store = Store(spark, shared_dir(spark, "test-reports"))
    first = P.initialize(spark, init, store, "i").collect()
    assert {(r.step, r.Symbol, r.status, r.n_rows) for r in first if "rejects" in r.step} == {
        ("price_rejects", "A", "bad_date", 1), ("sheet_rejects", "B", "unknown_report zz/12", 1)}
    outcomes = {(r.Symbol, r.status): r.n_rows for r in first if r.step in ("sheets", "dividends")}
    assert outcomes[("A", "committed cf/12")] == 1 and outcomes[("A", "no_report cf/3")] == 0
    assert outcomes[("D", "committed")] == 1 and outcomes[("A", "no_dividend_history")] == 0
    assert len(outcomes) == 4 * 7                            # six sheets and the dividends of every listed symbol
    assert not any("UNLISTED" in row for rows in _content(store).values() for row in rows)
    got = [(r.step, r.Symbol, r.status, r.n_rows) for r in P.daily_update(spark, daily, store, "d").collect()]
    assert ("rename_verdict", None, "all_renamed", 5) in got
    assert ("sheets", "E", "committed bs/3", 1) in got and ("dividends", "E", "committed", 1) in got
    assert ("sheet_rejects", "E", "unknown_report cf/6", 1) in got and ("price_rejects", "E", "bad_date", 1) in got
    assert {r.Symbol for r in store.read(S.SHEETS).collect()} == {"A", "DD", "E"}
    assert {r.Symbol for r in store.read(S.DIVIDENDS).collect()} == {"DD", "E"}


def test_stopped_runs_repeat_to_the_same_tables(spark, monkeypatch):
    """Stop before or after several writes of both jobs, repeat under the same id, compare with an uninterrupted run."""
    init, daily = _days(spark)
    whole = Store(spark, shared_dir(spark, "test-whole"))
    P.initialize(spark, init, whole, "i")
    P.daily_update(spark, daily, whole, "d")
    want = _content(whole)
    real = S.Run._write
    for job, at, modes in [("i", 4, (True,)), ("d", 2, (False,)), ("d", 10, (True,))]:
        for late in modes:
            store = Store(spark, shared_dir(spark, "test-stop"))
            if job == "d":
                P.initialize(spark, init, store, "i")
            before = _content(store)

            def stopping(self, name, df, *more, at=at, late=late):
                if self.writes + 1 == at and not late:
                    raise KeyboardInterrupt
                out = real(self, name, df, *more)
                if self.writes == at:
                    raise KeyboardInterrupt
                return out

            monkeypatch.setattr(S.Run, "_write", stopping)
            with pytest.raises(KeyboardInterrupt):
                P.initialize(spark, init, store, "i") if job == "i" else P.daily_update(spark, daily, store, "d")
            monkeypatch.setattr(S.Run, "_write", real)
            assert _content(store) == before                  # nothing of the stopped run shows
            if job == "i":
                P.initialize(spark, init, store, "i")
            P.daily_update(spark, daily, store, "d")
            assert _content(store) == want
    P.daily_update(spark, daily, whole, "d")                  # a committed run is not applied again
    assert _content(whole) == want


def test_daily_update_reads_the_download_once(spark):
    """Every downloaded row passes once, whatever is written, refused and counted of it."""
    from pyspark.sql import functions as F
    init, daily = _days(spark)
    store = Store(spark, shared_dir(spark, "test-once"))
    P.initialize(spark, init, store, "i")
    seen = spark.sparkContext.accumulator(0)

    def passed(date):
        seen.add(1)
        return date

    raw = daily.prices.withColumn("Volume", F.lit("???"))
    daily.prices = raw.withColumn("Date", F.udf(passed, "string").asNondeterministic()("Date"))
    got = {(r.step, r.Symbol): (r.status, r.n_rows) for r in P.daily_update(spark, daily, store, "d").collect()}
    assert seen.value == raw.count() == 5
    assert got[("prices", "A")] == ("committed", 1) and got[("prices", "B")] == ("already_latest", 0)
    assert got[("new_prices", "E")] == ("committed", 1) and got[("price_rejects", "E")] == ("bad_date", 1)
    assert got[("number_rejects", "A")] == ("Volume", 1) and got[("number_rejects", "E")] == ("Volume", 1)
    assert ("number_rejects", "B") not in got                # nothing of it was stored


def test_two_writers_do_not_overwrite_each_other(spark):
    store = Store(spark, shared_dir(spark, "test-two"))
    key = spark.createDataFrame([("A", "NYSE")], "Symbol string, Market string")
    a, b = store.run("a"), store.run("b")
    a.replace(S.KEY_TABLE, key)
    b.replace(S.KEY_TABLE, key)
    a.commit()
    with pytest.raises(RuntimeError, match="repeat run b"):
        b.commit()


def test_checkpoint_folder_is_required_off_local(monkeypatch):
    from tickerlake import session

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_rename_onto_existing_symbol_keeps_one_mark(spark):
    """A -> B while B has history: B's mark is the later date, and the refresh
    appends each newer row once (no duplicate marks, no duplicate rows)."""
    store = Store(spark, shared_dir(spark, "test-merge"))
    P.initialize(spark, P.Inputs(
        nasdaq=_listing(spark, ["A", "B"]), nyse=_listing(spark, []),
        prices=spark.createDataFrame([("A", "1/5/2020", 1.0, 1.0, 1.0, 1.0, "1"),
                                      ("B", "1/2/2020", 1.0, 1.0, 1.0, 1.0, "1")], RAW)), store)
    status = P.daily_update(spark, P.Inputs(
        nasdaq=_listing(spark, ["B"]), nyse=_listing(spark, []),
        prices=spark.createDataFrame([("B", "1/4/2020", 2.0, 2.0, 2.0, 2.0, "2"),
                                      ("B", "1/6/2020", 3.0, 3.0, 3.0, 3.0, "3")], RAW),
        changes=spark.createDataFrame([(1, "A", "B", "2020-01-05")], "pos int, Old string, New string, Date string")),
        store)
    got = {(r.step, r.Symbol): (r.status, r.n_rows) for r in status.collect() if r.step == "prices"}
    assert got[("prices", "B")] == ("committed", 1)          # only 1/6 is newer than max(1/5, 1/2)
    latest = store.read(S.LATEST).collect()
    assert [(r.Symbol, r.last_reference) for r in latest] == [("B", dt.date(2020, 1, 6))]
    assert store.read(S.PRICES).count() == 3
