"""Property checks against plain-Python brute force on random small lists."""
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickerlake.operators import clean, keys

SYMS = st.sampled_from(["A", "B", "C", "D", "E", None])
MARKETS = st.sampled_from(["NYSE", "NASDAQ", None])
LISTS = st.lists(st.tuples(SYMS, MARKETS), max_size=12)
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, data):
    return spark.createDataFrame(data, "Symbol string, Market string")


@SETTINGS
@given(db=LISTS, new=LISTS)
def test_compare_lists_matches_brute_force(spark, db, new):
    db_syms = {s for s, _ in db if s is not None}
    new_syms = {s for s, _ in new if s is not None}
    whole = lambda r: None not in r
    expect = Counter()
    expect.update((s, m, "old") for s, m in new if s in db_syms and whole((s, m)))
    expect.update((s, m, "new") for s, m in new if s not in db_syms and whole((s, m)))
    expect.update((s, m, "removed") for s, m in db if s not in new_syms and whole((s, m)))
    got = Counter(tuple(r) for r in keys.compare_lists(_df(spark, db), _df(spark, new)).collect())
    assert got == expect


@SETTINGS
@given(key_table=LISTS, cand=LISTS)
def test_new_keys_matches_brute_force(spark, key_table, cand):
    known = {s for s, _ in key_table if s is not None}
    expect = Counter((s, m) for s, m in cand if s not in known and s is not None and m is not None)
    got = Counter(tuple(r) for r in keys.new_keys(_df(spark, key_table), _df(spark, cand)).collect())
    assert got == expect
    summary = keys.new_keys_summary(_df(spark, key_table), _df(spark, cand)).first()
    assert summary.added == sum(expect.values())
    assert summary.ignored == sum(1 for s, m in cand if s in known and m is not None)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(0, 1000)), min_size=1, max_size=20,
                     unique_by=lambda t: t[1]))
def test_first_per_key_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(k, o, f"{k}{o}") for k, o in rows], "k string, o int, v string")
    expect = {}
    for k, o in sorted(rows, key=lambda t: t[1]):
        expect.setdefault(k, f"{k}{o}")
    got = {r.k: r.v for r in clean.first_per_key(df, ["k"], ["o"]).collect()}
    assert got == expect


LISTING = "Symbol string, Name string, LastSale string, MarketCap string, industry string, pos long"
RAW_SYMBOLS = st.sampled_from(["AB", "A B", " AB", "CD", "C D", "EF", None])
CAPS = st.sampled_from(["$1.5M", "$2.25B", "n/a", None, "$30M", "$0.125B"])
SALES = st.sampled_from(["1.015", "0.125", "n/a", "2.675", "10", None, "1d"])
ROWS = st.lists(st.tuples(RAW_SYMBOLS, SALES, CAPS), max_size=8)


def _brute_listing(nasdaq, nyse):
    """The documented step order, row by row in plain pandas/Python."""
    import re

    import pandas as pd
    out = []
    for src, (market, rows) in enumerate((("NASDAQ", nasdaq), ("NYSE", nyse))):
        for pos, (sym, sale, cap) in enumerate(rows):
            if cap == "n/a":
                continue                               # whole row becomes NULL, then dropped
            sym = None if sym is None else re.sub(r"\s+", "", sym)
            if sym is None:
                continue
            ok = sale is not None and re.fullmatch(r"\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*", sale)
            price = pd.Series([float(sale)]).round(2)[0] if ok else None
            number = None if cap is None else re.sub(r"[$MB]", "", cap)
            unit = None if cap is None else re.sub(r"[$0-9.]", "", cap)
            out.append((src, pos, sym, price, None if number is None else float(number), unit, market))
    first = {}
    for row in sorted(out, key=lambda r: (r[0], r[1])):
        first.setdefault(row[2], row[2:])
    return sorted(first.values(), key=lambda r: r[0])


@SETTINGS
@given(nasdaq=ROWS, nyse=ROWS)
def test_listing_clean_matches_brute_force(spark, nasdaq, nyse):
    def frame(rows):
        return spark.createDataFrame([(s, "n", sale, cap, "ind", i) for i, (s, sale, cap) in enumerate(rows)], LISTING)
    out = clean.listing_clean(frame(nasdaq), frame(nyse))
    got = sorted((tuple(r) for r in out.select("Symbol", "LastSale", "MarketCap", "MarketCapSym", "Market").collect()),
                 key=lambda r: r[0])
    assert got == _brute_listing(nasdaq, nyse)


DAYS = st.integers(1, 28)
PRICE_ROWS = st.lists(st.tuples(st.sampled_from(["A", "B", "C", "D"]), DAYS), max_size=15)


@SETTINGS
@given(stored=PRICE_ROWS, fetched=PRICE_ROWS)
def test_incremental_and_status_match_brute_force(spark, stored, fetched):
    import datetime as dt

    from tickerlake.operators import history
    schema = "Symbol string, Reference date"
    h = spark.createDataFrame([(s, dt.date(2020, 1, d)) for s, d in stored], schema)
    inc = spark.createDataFrame([(s, dt.date(2020, 1, d)) for s, d in fetched], schema)
    last = {}
    for s, d in stored:
        last[s] = max(last.get(s, 0), d)
    expect = Counter((s, d) for s, d in fetched if s in last and d > last[s])
    got = Counter((r.Symbol, r.Reference.day) for r in history.incremental_prices(h, inc).collect())
    assert got == expect
    req = spark.createDataFrame([(s,) for s in "ABCD"], "Symbol string")
    status = {r.Symbol: (r.status, r.n_rows) for r in history.refresh_status(req, h, inc).collect()}
    for s in "ABCD":
        n_in = sum(1 for x, _ in fetched if x == s)
        n_new = sum(1 for x, d in fetched if x == s and s in last and d > last[s])
        want = ("not_in_history", 0) if s not in last else ("no_price_history", 0) if n_in == 0 else \
            ("already_latest", 0) if n_new == 0 else ("committed", n_new)
        assert status[s] == want
