"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs against views named after the driver tables. The adapter CTEs
below mirror ``tickerlake.sources.adapters`` rule for rule; the query bodies are
written independently from the Spark jobs, in plain SQL.
"""

from __future__ import annotations

# Fixed values, stated here again so that a fault in the engine's own shows: what
# counts as a number, the generated sheets' label, and the report parameters.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"
SHEET_LABEL = "Fiscal year ends in December. USD in millions"
DIVIDEND_AS_OF, DIVIDEND_YEARS = "2001-08-01", 3
ANNUAL_PERIODS = ["1995", "1996", "1997", "1998", "1999", "2000", "2001"]
QUARTERLY_PERIODS = [f"{y}-Q{q}" for y in ANNUAL_PERIODS for q in (1, 2, 3, 4)][:-1]  # orders end in 2001-Q3


def _num(x: str) -> str:
    return f"(case when regexp_full_match({x}, '{NUMBER_PATTERN}') then try_cast({x} as double) end)"


def _iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


SIX_SHEETS = "(values ('is', 3), ('is', 12), ('bs', 3), ('bs', 12), ('cf', 3), ('cf', 12)) k(report, freq)"


def _bad_volumes(job: str, src: str) -> str:
    """Status rows of volumes that hold a text, yet no number."""
    bad = f"""volume_text not in ('', 'n/a') and {_num("replace(volume_text, ',', '')")} is null"""
    return f"select '{job}', 'number_rejects', Symbol, 'Volume', count(*) from {src} where {bad} group by Symbol"


def _sheet_log(job: str, asked: str, cells: str, there: str) -> str:
    """Status rows of the six sheets of each symbol of ``asked``, from the cells that came and the keys already stored."""
    return f"""
select '{job}', 'sheets', a.Symbol,
       case when c.cells is null then 'no_report' when t.Symbol is not null then 'already_present'
            when c.live = 0 then 'empty_report' else 'committed' end || ' ' || k.report || '/' || k.freq,
       case when c.cells is not null and t.Symbol is null then coalesce(c.live, 0) else 0 end
from (select distinct Symbol from {asked} where Symbol is not null) a cross join {SIX_SHEETS}
left join (select Symbol, report, freq, sum(n) as cells, sum(case when filled > 0 then n else 0 end) as live
           from (select Symbol, report, freq, period, count(*) as n, count(value) as filled from {cells} group by all)
           group by Symbol, report, freq) c on c.Symbol = a.Symbol and c.report = k.report and c.freq = k.freq
left join (select distinct Symbol, report, freq from {there}) t on t.Symbol = a.Symbol and t.report = k.report and t.freq = k.freq"""


def _dividend_log(job: str, asked: str, rows: str, there: str) -> str:
    return f"""
select '{job}', 'dividends', a.Symbol,
       case when c.n is null then 'no_dividend_history' when t.Symbol is not null then 'already_present' else 'committed' end,
       case when t.Symbol is null then coalesce(c.n, 0) else 0 end
from (select distinct Symbol from {asked} where Symbol is not null) a
left join (select Symbol, count(*) as n from {rows} group by Symbol) c on c.Symbol = a.Symbol
left join (select distinct Symbol from {there}) t on t.Symbol = a.Symbol"""


PRICE_ROWS = f"""
  select 'S' || l_partkey as Symbol,
         case when l_quantity >= 50 then '13/45/2017' else strftime(l_shipdate, '%-m/%-d/%Y') end as Date,
         l_extendedprice as Open,
         l_extendedprice * (1 + l_tax) as High,
         l_extendedprice * (1 - l_discount) as Low,
         l_extendedprice as Close,
         case when l_linenumber = 7 then '???'
              when l_returnflag = 'A' then cast(cast(l_quantity as bigint) as varchar)
              else cast(cast(l_quantity as bigint) as varchar) || ',' || lpad(cast(l_linenumber as varchar), 3, '0')
         end as Volume,
         l_linestatus, l_partkey
  from lineitem"""


def _clean_prices(src: str) -> str:
    return f"""
  select Symbol, cast(try_strptime(Date, '%m/%d/%Y') as date) as Reference, Open, High, Low, Close,
         {_num("replace(Volume, ',', '')")} as Volume, Volume as volume_text
  from {src} where try_strptime(Date, '%m/%d/%Y') is not null"""


PRICES = f"""
raw as ({PRICE_ROWS}),
stored as ({_clean_prices("(select * from raw where l_linestatus = 'F' and l_partkey % 10 <> 3)")}),
incoming as ({_clean_prices("(select * from raw where l_partkey % 10 <> 7)")})"""

def _listings(prefix: str = "T", skip_segment: str | None = None, suffix: str = "") -> str:
    skip = f"where c_mktsegment <> '{skip_segment}'" if skip_segment else ""
    return f"""
nasdaq{suffix} as (
  select '{prefix} ' || c_custkey as Symbol, c_name as Name, cast(c_acctbal / 3 as varchar) as LastSale,
         case when c_acctbal < 0 then 'n/a' when c_mktsegment = 'HOUSEHOLD' then null
              else '$' || c_nationkey || '.5' || case when c_acctbal > 5000 then 'B' else 'M' end end as MarketCap,
         c_mktsegment as industry, 'NASDAQ' as Market, 0 as src, c_custkey as pos
  from customer {skip}),
nyse{suffix} as (
  select '{prefix}' || p_partkey as Symbol, p_name as Name, cast(p_retailprice / 3 as varchar) as LastSale,
         case when p_size > 45 then 'n/a'
              else '$' || p_size || '.25' || case when p_retailprice > 950 then 'B' else 'M' end end as MarketCap,
         p_type as industry, 'NYSE' as Market, 1 as src, p_partkey as pos
  from part),
listing{suffix} as (select * from nasdaq{suffix} union all select * from nyse{suffix})"""


def _listing_keys(src: str) -> str:
    """Cleaned listing reduced to (Symbol, Market), first row per Symbol."""
    return f"""
  select Symbol, Market from (
    select regexp_replace(Symbol, '\\s+', '', 'g') as Symbol, Market, src, pos from {src}
    where regexp_replace(MarketCap, '[$MB]', '', 'g') is distinct from 'n/a')
  where Symbol is not null
  qualify row_number() over (partition by Symbol order by src, pos) = 1"""


LISTINGS = _listings()

KEYS = """
keyrows as (
  select 'S' || c_custkey as Symbol,
         case when c_acctbal < 0 then null when c_nationkey < 12 then 'NYSE' else 'NASDAQ' end as Market,
         c_mktsegment
  from customer),
kd as (select Symbol, Market from keyrows where c_mktsegment <> 'AUTOMOBILE'),
kn as (select Symbol, Market from keyrows where c_mktsegment <> 'BUILDING')"""

def _changes(keys_src: str = "kd") -> str:
    return """
ch as (
  select s_acctbal as bal, s_suppkey as k, 'S' || s_suppkey as Old, 'S' || (s_suppkey + 1) as New,
         case when s_nationkey = 0 then null else '2017-01-01' end as Date
  from supplier),
e as (
  select * from ch
  where Old in (select Symbol from """ + keys_src + """ where Symbol is not null)
    and Old is not null and New is not null and Date is not null),
nxt as (
  select c.k, c.New,
         first(e2.k order by e2.bal, e2.k) filter (where e2.k is not null) as nk
  from e c left join e e2
    on e2.Old = c.New and (e2.bal > c.bal or (e2.bal = c.bal and e2.k > c.k))
  group by c.k, c.New),
firsts as (select Old, first(k order by bal, k) as k from e group by Old),
walk as (
  select * from (
    with recursive w(start_old, k, New, nk) as (
      select f.Old, n.k, n.New, n.nk from firsts f join nxt n on n.k = f.k
      union all
      select w.start_old, n.k, n.New, n.nk from w join nxt n on n.k = w.nk
    )
    select start_old as Old, New from w where nk is null)),
rmap as (select Old, New from walk)"""


CHANGES = _changes()


def _dividend_rows(status: str) -> str:
    cents = "lpad(cast(o_orderkey % 100 as varchar), 2, '0')"
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    return f"""
  select 'S' || o_custkey as Symbol, {day} as "Ex-Dividend Date", {day} as "Declaration Date",
         {day} as "Record Date", {day} as "Payable Date", 'Cash' as "Dividend Type",
         case when o_orderpriority = '1-URGENT' then 'USD 0.' || {cents}
              when o_orderpriority = '2-HIGH' then '0.' || {cents} || 'USD'
              else '$0.' || {cents} end as Amount
  from orders where o_orderstatus = '{status}'"""


DIVIDENDS = f"""
past as ({_dividend_rows('F')}),
upcoming as ({_dividend_rows('O')}),
divs as (
  select Symbol, "Ex-Dividend Date" as "Ex-Dividend_Date", "Declaration Date" as "Declaration_Date",
         "Record Date" as "Record_Date", "Payable Date" as "Payable_Date", "Dividend Type" as "Dividend_Type",
         regexp_replace(regexp_replace(Amount, '(/\\s/g)?([A-Z]?)', '', 'g'), '\\$', '', 'g') as Amount,
         regexp_extract(Amount, '([A-Z]*)', 1) as Currency
  from (select * from past
        union all
        select * from upcoming where Symbol in (select Symbol from past where Symbol is not null)))"""


def _sheet_rows(where: str = "") -> str:
    return f"""
  select 'S' || o_custkey as Symbol,
         case o_orderkey % 3 when 0 then 'is' when 1 then 'bs' else 'cf' end as report,
         case when o_orderkey % 2 = 0 then 12 else 3 end as freq,
         o_orderkey as pos,
         o_orderpriority as item,
         '{SHEET_LABEL}' as label,
         case when o_orderkey % 2 = 0 then strftime(o_orderdate, '%Y')
              else strftime(o_orderdate, '%Y') || '-Q' || cast(quarter(o_orderdate) as varchar) end as period,
         case when o_orderstatus = 'P' then null else o_totalprice end as value
  from orders {where}"""


SHEETS = f"""
sheet as ({_sheet_rows()}),
sheet_stored as ({_sheet_rows("where o_orderdate < timestamp '1997-01-01'")}),
sheet_mixed as (
  select Symbol, case when pos % 29 = 0 then 'zz' else report end as report,
         case when pos % 31 = 0 then 6 else freq end as freq, pos, item, label, period, value from sheet)"""


def _pivot(report: str, freq: int, periods: list[str], title: str) -> str:
    cols = ",\n         ".join(f"max(case when period = '{p}' then value end) as \"{p}\"" for p in periods)
    return f"""
with {SHEETS}
select Symbol, pos, item as "{title}",
         {cols}
from sheet where report = '{report}' and freq = {freq}
group by Symbol, pos, item"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


# The tables after the initial load (0), after the renames (1), and what one daily update adds to them.
INITIAL = """
p0 as (select * from stored where Symbol in (select Symbol from kb)),
s0 as (select * from sheet_stored where Symbol in (select Symbol from kb)
       qualify count(value) over (partition by Symbol, report, freq, period) > 0),
d0 as (select * from divs where Symbol in (select Symbol from kb))"""


DAILY = _with(_listings("S", "AUTOMOBILE", "_i"), _listings("S", "BUILDING", "_d"), PRICES, SHEETS, DIVIDENDS) + """,
kb as (""" + _listing_keys("listing_i") + """),
dl as (""" + _listing_keys("listing_d") + """),""" + INITIAL + """,""" + _changes("kb") + """,
p1 as (select coalesce(m.New, p.Symbol) as Symbol, p.Reference from p0 p left join rmap m on m.Old = p.Symbol),
s1 as (select coalesce(m.New, s.Symbol) as Symbol, s.report, s.freq, s.period from s0 s left join rmap m on m.Old = s.Symbol),
d1 as (select coalesce(m.New, d.Symbol) as Symbol, d."Ex-Dividend_Date" from d0 d left join rmap m on m.Old = d.Symbol),
lat1 as (select Symbol, max(Reference) as last from p1 group by Symbol),
ka as (select coalesce(m.New, k.Symbol) as Symbol, k.Market from kb k left join rmap m on m.Old = k.Symbol),
cmp as (
  select Symbol, Market, 'old' as category from dl
  where Symbol in (select Symbol from ka where Symbol is not null) and Symbol is not null and Market is not null
  union all
  select Symbol, Market, 'new' from dl
  where not exists (select 1 from ka where ka.Symbol = dl.Symbol) and Symbol is not null and Market is not null
  union all
  select Symbol, Market, 'removed' from ka
  where not exists (select 1 from dl where dl.Symbol = ka.Symbol) and Symbol is not null and Market is not null),
old_syms as (select distinct Symbol from cmp where category = 'old'),
new_rows as (select Symbol, Market from cmp where category = 'new'),
old_rows as (select * from incoming where Symbol in (select Symbol from old_syms)),
per as (select o.Symbol, count(*) as n_incoming, count(*) filter (where o.Reference > l.last) as n_new
        from old_rows o left join lat1 l on l.Symbol = o.Symbol group by o.Symbol),
st as (select r.Symbol,
              case when l.last is null then 'not_in_history'
                   when coalesce(p.n_incoming, 0) = 0 then 'no_price_history'
                   when p.n_new = 0 then 'already_latest' else 'committed' end as status,
              p.n_new
       from old_syms r left join lat1 l on l.Symbol = r.Symbol left join per p on p.Symbol = r.Symbol),
p_old as (select o.Symbol, o.Reference, o.volume_text from old_rows o join lat1 l on l.Symbol = o.Symbol where o.Reference > l.last),
p_new as (select Symbol, Reference, volume_text from incoming
          where Symbol in (select Symbol from new_rows) and Symbol not in (select Symbol from lat1)),
added as (select Symbol, Market from new_rows
          where Symbol not in (select Symbol from ka where Symbol is not null)),
s_new as (
  select Symbol, report, freq, period from sheet_mixed m
  where Symbol in (select Symbol from added) and report in ('is', 'bs', 'cf') and freq in (3, 12)
    and not exists (select 1 from s1 where s1.Symbol = m.Symbol and s1.report = m.report and s1.freq = m.freq)
  qualify count(value) over (partition by Symbol, report, freq, period) > 0),
d_new as (select Symbol, "Ex-Dividend_Date" from divs
          where Symbol in (select Symbol from added) and Symbol not in (select Symbol from d1)),
msg as (select case when count(*) = 0 then 'No new records to add.'
                    else printf('Added %d records.', count(*)) end as m from added)"""


ORACLE: dict[str, str] = {
    "incremental_prices": _with(PRICES) + f"""
select i.Symbol, {_iso('i.Reference')} as Reference, i.Open, i.High, i.Low, i.Close, i.Volume
from incoming i join (select Symbol, max(Reference) as last from stored group by Symbol) m
  on i.Symbol = m.Symbol
where i.Reference > m.last""",

    "latest_per_key": _with(PRICES) + f"""
select Symbol, {_iso('max(Reference)')} as last_reference from stored group by Symbol""",

    "price_history": _with(PRICES) + f"""
select Symbol, {_iso('Reference')} as Reference, Open, High, Low, Close, Volume
from ({_clean_prices('raw')})""",

    "price_rejects": _with(PRICES) + """
select Symbol, count(*) as n_bad_dates from raw where try_strptime(Date, '%m/%d/%Y') is null group by Symbol""",

    "listing_clean": _with(LISTINGS) + f"""
select Symbol, Name, LastSale, MarketCap, Industry, Market, MarketCapSym from (
  select regexp_replace(Symbol, '\\s+', '', 'g') as Symbol, Name,
         round_even({_num('LastSale')} * 100, 0) / 100 as LastSale,
         {_num("regexp_replace(MarketCap, '[$MB]', '', 'g')")} as MarketCap,
         industry as Industry, Market,
         regexp_replace(MarketCap, '[$0-9.]', '', 'g') as MarketCapSym,
         src, pos
  from listing
  where regexp_replace(MarketCap, '[$MB]', '', 'g') is distinct from 'n/a')
where Symbol is not null
qualify row_number() over (partition by Symbol order by src, pos) = 1""",

    "first_per_key": _with(LISTINGS) + """
select Symbol, Name, Market, pos from (
  select regexp_replace(Symbol, '\\s+', '', 'g') as Symbol, Name, Market, src, pos from listing)
qualify row_number() over (partition by Symbol order by src, pos) = 1""",

    "split_amount": _with(DIVIDENDS) + """
select Symbol, "Ex-Dividend Date",
       regexp_replace(regexp_replace(Amount, '(/\\s/g)?([A-Z]?)', '', 'g'), '\\$', '', 'g') as Amount,
       regexp_extract(Amount, '([A-Z]*)', 1) as Currency
from past""",

    "dividend_history": _with(DIVIDENDS) + """
select * from divs""",

    "dividend_window": _with(DIVIDENDS) + f"""
select * from divs
where cast(coalesce(try_strptime("Ex-Dividend_Date", '%Y-%m-%d'), try_strptime("Ex-Dividend_Date", '%m/%d/%Y')) as date)
      > cast(date '{DIVIDEND_AS_OF}' - interval {DIVIDEND_YEARS} year as date)""",

    "underscore_columns": _with(DIVIDENDS) + """
select Symbol, "Ex-Dividend Date" as "Ex-Dividend_Date", "Declaration Date" as "Declaration_Date",
       "Record Date" as "Record_Date", "Payable Date" as "Payable_Date",
       "Dividend Type" as "Dividend_Type", Amount
from past""",

    "key_first": _with(SHEETS) + """
select Symbol, report, freq, pos, item, label, period, value from sheet""",

    "drop_null_columns": f"""
with {SHEETS}
select Symbol, pos, item as "Cashflow_item",
       {", ".join(f"max(case when period = '{p}' then value end) as \"{p}\"" for p in ANNUAL_PERIODS)}
from sheet where report = 'cf' and freq = 12
group by Symbol, pos, item""",

    "drop_null_periods": _with(SHEETS) + """
select * from sheet
qualify count(value) over (partition by Symbol, report, freq, period) > 0""",

    "format_sheet": _pivot("is", 12, ANNUAL_PERIODS, "Income_item"),
    "annual_cashflow": _pivot("cf", 12, ANNUAL_PERIODS, "Cashflow_item"),
    "quarterly_cashflow": _pivot("cf", 3, QUARTERLY_PERIODS, "Cashflow_item"),

    "key_exists": _with(PRICES, KEYS) + """
select k.Symbol, k.Market, exists (select 1 from stored s where s.Symbol = k.Symbol) as has_history
from kd k""",

    "append_new_history": _with(PRICES) + f"""
select i.Symbol, {_iso('i.Reference')} as Reference, i.Open, i.High, i.Low, i.Close, i.Volume
from incoming i
where not exists (select 1 from stored s where s.Symbol = i.Symbol)""",

    "rejected_history": _with(PRICES) + """
select Symbol, count(*) as n_rows, 'already_present' as status from incoming i
where exists (select 1 from stored s where s.Symbol = i.Symbol)
group by Symbol""",

    "route_report": _with(SHEETS) + """
select *, case
    when report = 'is' and freq = 3 then 'TenQIncome' when report = 'is' and freq = 12 then 'TenKIncome'
    when report = 'bs' and freq = 3 then 'TenQBalance' when report = 'bs' and freq = 12 then 'TenKBalance'
    when report = 'cf' and freq = 3 then 'TenQCashflow' when report = 'cf' and freq = 12 then 'TenKCashflow'
  end as "table"
from sheet s
where not exists (select 1 from sheet_stored t
                  where t.Symbol = s.Symbol and t.report = s.report and t.freq = s.freq)""",

    "route_rejects": _with(SHEETS) + """
select Symbol, report, freq, count(*) as n_rows, 'unknown_report' as status from sheet_mixed
where (report, freq) not in (('is', 3), ('is', 12), ('bs', 3), ('bs', 12), ('cf', 3), ('cf', 12))
group by Symbol, report, freq""",

    "compare_lists": _with(KEYS) + """
select Symbol, Market, 'old' as category from kn
where Symbol in (select Symbol from kd where Symbol is not null) and Symbol is not null and Market is not null
union all
select Symbol, Market, 'new' from kn
where not exists (select 1 from kd where kd.Symbol = kn.Symbol) and Symbol is not null and Market is not null
union all
select Symbol, Market, 'removed' from kd
where not exists (select 1 from kn where kn.Symbol = kd.Symbol) and Symbol is not null and Market is not null""",

    "new_keys": _with(KEYS) + """
select Symbol, Market from kn
where not exists (select 1 from kd where kd.Symbol = kn.Symbol) and Symbol is not null and Market is not null""",

    "new_keys_summary": _with(KEYS) + """
select added, ignored,
       case when added = 0 then 'No new records to add.'
            when ignored > 0 then printf('Added %d records and ignored %d records.', added, ignored)
            else printf('Added %d records.', added) end as message
from (
  select count(*) filter (where not known) as added, count(*) filter (where known) as ignored
  from (select exists (select 1 from kd where kd.Symbol = kn.Symbol) as known
        from kn where Symbol is not null and Market is not null))""",

    "refresh_status": _with(PRICES, KEYS) + """,
marks as (select Symbol, max(Reference) as last from stored group by Symbol),
per as (
  select i.Symbol, count(*) as n_incoming, count(*) filter (where i.Reference > m.last) as n_new
  from incoming i left join marks m on i.Symbol = m.Symbol group by i.Symbol),
req as (select distinct Symbol from kd where Symbol is not null),
st as (
  select r.Symbol,
         case when m.last is null then 'not_in_history'
              when coalesce(p.n_incoming, 0) = 0 then 'no_price_history'
              when p.n_new = 0 then 'already_latest'
              else 'committed' end as status,
         p.n_new
  from req r left join marks m on r.Symbol = m.Symbol left join per p on r.Symbol = p.Symbol)
select Symbol, status, cast(case when status = 'committed' then n_new else 0 end as bigint) as n_rows from st""",

    "rename_map": _with(KEYS, CHANGES) + """
select Old, New from rmap""",

    "rename_keys": _with(PRICES, KEYS, CHANGES) + f"""
select coalesce(m.New, s.Symbol) as Symbol, {_iso('s.Reference')} as Reference,
       s.Open, s.High, s.Low, s.Close, s.Volume
from stored s left join rmap m on m.Old = s.Symbol""",

    "read_offset_csv": _with(PRICES) + """
select Symbol, Date, Open, High, Low, Close, Volume from raw""",

    "read_sheets": _with(SHEETS) + """,
cell as (select Symbol, report, freq, pos, item, period, max(value) as value
         from sheet group by Symbol, report, freq, pos, item, period),
periods as (select distinct Symbol, report, freq, period, label from sheet),
items as (select distinct Symbol, report, freq, pos, item from sheet),
ranked as (select *, dense_rank() over (partition by Symbol, report, freq order by pos) as rk from items)
select r.Symbol, r.report, r.freq, cast(r.rk as bigint) as pos, r.item, p.label, p.period, c.value
from ranked r
join periods p on p.Symbol = r.Symbol and p.report = r.report and p.freq = r.freq
left join cell c on c.Symbol = r.Symbol and c.report = r.report and c.freq = r.freq
                and c.pos = r.pos and c.period = p.period""",

    "read_reordered_csv": _with(PRICES) + """
select Symbol, Date, Open, High, Low, Close, Volume from raw""",

    "initialize": _with(_listings("S", "AUTOMOBILE", "_i"), PRICES, SHEETS, DIVIDENDS) + """,
kb as (""" + _listing_keys("listing_i") + """),""" + INITIAL + """
select 'initialize' as job, 'key_table' as step, Symbol, 'created' as status, cast(1 as bigint) as n_rows
from kb
union all
select 'initialize', 'new_prices', kb.Symbol, case when n is null then 'no_price_history' else 'committed' end, coalesce(n, 0)
from kb left join (select Symbol, count(*) as n from p0 group by Symbol) p on p.Symbol = kb.Symbol
union all
select 'initialize', 'price_rejects', Symbol, 'bad_date', count(*) from raw
where l_linestatus = 'F' and l_partkey % 10 <> 3 and try_strptime(Date, '%m/%d/%Y') is null
  and Symbol in (select Symbol from kb) group by Symbol
union all """ + _bad_volumes("initialize", "p0") + """
union all """ + _sheet_log("initialize", "kb", "sheet_stored", "(select * from kb where false) x, (select null as report, null as freq) y") + """
union all """ + _dividend_log("initialize", "kb", "d0", "(select * from kb where false)"),

    "daily_update": DAILY + """
select 'daily_update' as job, 'rename' as step, Old as Symbol,
       printf('Updated %s with %s in %s table', Old, New, t.name) as status, cast(1 as bigint) as n_rows
from e, (select unnest(['AllStocksKey', 'Dividends', 'LatestPrice', 'Sheets', 'TenYrPrices']) as name) t
union all
select 'daily_update', 'compare', Symbol, category, 1 from cmp
union all
select 'daily_update', 'prices', Symbol, status, case when status = 'committed' then n_new else 0 end from st
union all
select 'daily_update', 'new_prices', r.Symbol,
       case when i.n is null then 'no_price_history' when l.last is not null then 'already_present' else 'committed' end,
       case when l.last is null then coalesce(i.n, 0) else 0 end
from (select distinct Symbol from new_rows) r left join lat1 l on l.Symbol = r.Symbol
left join (select Symbol, count(*) as n from incoming group by Symbol) i on i.Symbol = r.Symbol
union all
select 'daily_update', 'price_rejects', Symbol, 'bad_date', count(*) from raw
where l_partkey % 10 <> 7 and try_strptime(Date, '%m/%d/%Y') is null and Symbol in (select Symbol from dl) group by Symbol
union all """ + _bad_volumes("daily_update", "(select * from p_old union all select * from p_new)") + """
union all
select 'daily_update', 'rename_verdict', null, 'all_renamed', 5 * count(*) from (select distinct Old, New from e)
union all
select 'daily_update', 'new_keys', Symbol, (select m from msg), 1 from added
union all
select 'daily_update', 'sheet_rejects', Symbol, 'unknown_report ' || report || '/' || freq, count(*) from sheet_mixed
where Symbol in (select Symbol from added) and not (report in ('is', 'bs', 'cf') and freq in (3, 12))
group by Symbol, report, freq
union all """ + _sheet_log("daily_update", "added", "sheet_mixed", "s1") + """
union all """ + _dividend_log("daily_update", "added", "divs", "d1"),

    "daily_tables": DAILY + """
select 'TenYrPrices' as "table", Symbol, count(*) as n_rows, strftime(max(Reference), '%Y-%m-%d') as last
from (select Symbol, Reference from p1 union all select Symbol, Reference from p_old union all select Symbol, Reference from p_new)
group by Symbol
union all
select 'LatestPrice', Symbol, 1, strftime(max(Reference), '%Y-%m-%d')
from (select Symbol, Reference from p1 union all select Symbol, Reference from p_old union all select Symbol, Reference from p_new)
group by Symbol
union all
select 'Sheets', Symbol, count(*), max(period)
from (select Symbol, period from s1 union all select Symbol, period from s_new) group by Symbol
union all
select 'Dividends', Symbol, count(*), max("Ex-Dividend_Date")
from (select Symbol, "Ex-Dividend_Date" from d1 union all select Symbol, "Ex-Dividend_Date" from d_new) group by Symbol
union all
select 'AllStocksKey', Symbol, count(*), max(Market)
from (select * from ka union all select * from added) group by Symbol""",

    "report_outcomes": _with(SHEETS, DIVIDENDS, KEYS) + ", log(job, step, Symbol, status, n_rows) as (" + _sheet_log("", "kd", "sheet_mixed", "sheet_stored")
    + "\nunion all" + _dividend_log("", "kd", "divs", """(select 'S' || o_custkey as Symbol from orders
      where o_orderstatus = 'F' and o_orderdate < timestamp '1995-03-01')""") + """)
select Symbol, case when step = 'sheets' then regexp_extract(status, ' (.*)/', 1) else 'div' end as report,
       case when step = 'sheets' then cast(regexp_extract(status, '/(.*)', 1) as int) end as freq,
       regexp_extract(status, '^[a-z_]+') as outcome, cast(n_rows as bigint) as n_rows from log
union all
select Symbol, report, freq, 'unknown_report', count(*) from sheet_mixed
where Symbol in (select Symbol from kd) and (report, freq) not in (select * from """ + SIX_SHEETS + """)
group by Symbol, report, freq""",

    "number_rejects": _with(PRICES, LISTINGS) + f"""
, messy as (
  select regexp_replace(Symbol, '\\s+', '', 'g') as Symbol,
         case when pos % 23 = 0 then 'call' when pos % 29 = 0 then null else LastSale end as sale,
         regexp_replace(case when pos % 31 = 0 then '$1.5K' else MarketCap end, '[$MB]', '', 'g') as cap from listing)
select 'prices' as source, Symbol, 'Volume' as "column", count(*) as n_cells from raw
where try_strptime(Date, '%m/%d/%Y') is not null and {_num("replace(Volume, ',', '')")} is null group by Symbol
union all
select 'listing', Symbol, 'LastSale', count(*) from messy
where cap is distinct from 'n/a' and sale is not null and {_num("sale")} is null group by Symbol
union all
select 'listing', Symbol, 'MarketCap', count(*) from messy
where cap <> 'n/a' and cap <> '' and {_num("cap")} is null group by Symbol""",

    "create_key_table": _with(_listings("S", "AUTOMOBILE")) + ", kb as (" + _listing_keys("listing") + """)
select Symbol, Market, 'already_exists' as second_attempt from kb""",

    "evolved_dividends": _with(DIVIDENDS) + """
select Symbol, "Ex-Dividend Date" as "Ex-Dividend_Date", "Declaration Date" as "Declaration_Date", "Record Date" as "Record_Date",
       "Payable Date" as "Payable_Date", "Dividend Type" as "Dividend_Type", Amount, null as Currency from past
union all
select Symbol, "Ex-Dividend_Date", "Declaration_Date", "Record_Date", "Payable_Date", "Dividend_Type", Amount, Currency from divs""",

    "renamed_tables": _with(PRICES, SHEETS, DIVIDENDS, KEYS, CHANGES) + f"""
select 'TenYrPrices' as "table", coalesce(m.New, s.Symbol) as Symbol, {_iso('s.Reference')} as "row", s.Open, s.High, s.Low, s.Close, s.Volume
from stored s left join rmap m on m.Old = s.Symbol
union all
select 'Sheets', coalesce(m.New, s.Symbol), concat_ws('/', s.report, s.freq, s.pos, s.item, s.label, s.period), s.value, null, null, null, null
from sheet_stored s left join rmap m on m.Old = s.Symbol
union all
select 'Dividends', coalesce(m.New, s.Symbol),
       concat_ws('/', "Ex-Dividend_Date", "Declaration_Date", "Record_Date", "Payable_Date", "Dividend_Type", Amount, Currency), null, null, null, null, null
from divs s left join rmap m on m.Old = s.Symbol""",

    "renames_done": _with(PRICES, SHEETS, DIVIDENDS, KEYS, CHANGES) + """,
ex as (select distinct e.Old, e.New, m.New as final from e join rmap m on m.Old = e.Old)
select 'TenYrPrices' as "table", count(*) as n_expected, count(*) as n_reported, true as all_renamed from ex
union all
select 'Sheets', count(*), count(*), true from ex
union all
select 'Dividends', count(*), count(*) filter (where ok), coalesce(bool_and(ok), true) from (
  select Old not in (select Symbol from divs)
         or (final in (select Symbol from divs) and Old in (select coalesce(m.New, d.Symbol) from divs d left join rmap m on m.Old = d.Symbol)) as ok
  from ex)""",

    "rename_audit": _with(KEYS, CHANGES) + """
select Old, New, t.name as "table", printf('Updated %s with %s in %s table', Old, New, t.name) as message
from e, (select unnest(['AllStocksKey', 'TenYrPrices', 'Dividends', 'TenKIncome', 'TenKBalance',
                        'TenKCashflow', 'TenQIncome', 'TenQBalance', 'TenQCashflow']) as name) t""",
}

# Short lines read like full ones.
ORACLE["read_short_sheets"] = ORACLE["read_sheets"]
# Listing files hold the listing.
ORACLE["read_listing"] = ORACLE["listing_clean"]
