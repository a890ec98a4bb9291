import os
import tempfile

from helpers import rows
from tickerlake.sources import offset_csv as CSV

PRICE_SCHEMA = "Date STRING, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE, Volume STRING"


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def test_read_offset_csv_title_and_blank_lines(spark):
    d = tempfile.mkdtemp(prefix="tl-prices-")
    _write(d, "ACME.csv", "ACME daily history\nDate,Open,High,Low,Close,Volume\n"
                          "1/5/2017,1,2,1,2,\"1,234\"\n01/06/2017,2,3,2,3,???\n")
    _write(d, "BOLT.csv", "\n\nBOLT daily history\n\nDate,Open,High,Low,Close,Volume\n\n3/1/2018,5,6,4,5,77\n")
    out = CSV.read_offset_csv(spark, d, 1, PRICE_SCHEMA)
    assert rows(out, "Symbol", "Date", "Volume") == [
        ("ACME", "01/06/2017", "???"), ("ACME", "1/5/2017", "1,234"), ("BOLT", "3/1/2018", "77")]
    assert CSV.header_mismatches(spark, d, 1, ["Date", "Open", "High", "Low", "Close", "Volume"]).count() == 0


def test_read_offset_csv_skip_two(spark):
    d = tempfile.mkdtemp(prefix="tl-ratios-")
    _write(d, "ACME.csv", "Growth ratios for ACME\nKey Financials USD\nitem,2016,2017\nRevenue,1,2\n")
    out = CSV.read_offset_csv(spark, d, 2, "item STRING, `2016` STRING, `2017` STRING")
    assert rows(out, "Symbol", "item", "2016", "2017") == [("ACME", "Revenue", "1", "2")]


def test_read_sheets_quoted_and_empty_cells(spark):
    d = tempfile.mkdtemp(prefix="tl-sheets-")
    _write(d, "ACME.csv", 'ACME CORP CASH FLOW\n"Fiscal year ends in December. USD in millions",2015-12,2016-12,TTM\n'
                          '"Cash, operating",10,20,\nSection,,,\n')
    out = CSV.read_sheets(spark, d, 1)
    got = rows(out, "Symbol", "pos", "item", "period", "value")
    assert got == [("ACME", 1, "Cash, operating", "2015-12", 10.0), ("ACME", 1, "Cash, operating", "2016-12", 20.0),
                   ("ACME", 1, "Cash, operating", "TTM", None), ("ACME", 2, "Section", "2015-12", None),
                   ("ACME", 2, "Section", "2016-12", None), ("ACME", 2, "Section", "TTM", None)]
    assert {r.label for r in out.collect()} == {"Fiscal year ends in December. USD in millions"}


def test_large_file_split_across_tasks(spark):
    """A file bigger than one split: later splits get their header by join."""
    d = tempfile.mkdtemp(prefix="tl-big-")
    periods = ",".join(f"P{i}" for i in range(3))
    body = "".join(f"item{i},{i},{i + 1},{i + 2}\n" for i in range(20000))
    _write(d, "BIG.csv", f"BIG title\nFiscal year ends,{periods}\n{body}")
    _write(d, "SMALL.csv", "SMALL title\nFiscal year ends,P0\nx,1\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "8192")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 2
        out = CSV.read_sheets(spark, d, 1)
        agg = out.groupBy("Symbol").count().collect()
        assert {r.Symbol: r["count"] for r in agg} == {"BIG": 60000, "SMALL": 1}
        assert out.where("period is null or value is null").count() == 0
        assert out.where("Symbol = 'BIG'").select("pos").distinct().count() == 20000
        prices = CSV.read_offset_csv(spark, d, 1, "`Fiscal year ends` STRING, P0 DOUBLE")
        assert prices.where("Symbol = 'BIG'").count() == 20000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_writers_round_trip(spark):
    from tickerlake.session import shared_dir
    long = spark.createDataFrame([
        ("A", "cf", 12, 1, "Cash, op", "Fiscal year", "2016", 1.5),
        ("A", "cf", 12, 1, "Cash, op", "Fiscal year", "2017", None),
        ("A", "cf", 12, 2, "Capex", "Fiscal year", "2017", -2.0),
    ], "Symbol string, report string, freq int, pos long, item string, label string, period string, value double")
    out = CSV.write_sheets(long, shared_dir(spark, "test-sheets"))
    back = CSV.read_sheets(spark, out, 1)
    assert rows(back, "Symbol", "report", "freq", "pos", "item", "period", "value") == [
        ("A", "cf", 12, 1, "Cash, op", "2016", 1.5), ("A", "cf", 12, 1, "Cash, op", "2017", None),
        ("A", "cf", 12, 2, "Capex", "2016", None), ("A", "cf", 12, 2, "Capex", "2017", -2.0)]


def test_read_key_ratios_header_on_row_three(spark):
    d = tempfile.mkdtemp(prefix="tl-ratios2-")
    _write(d, "ACME.csv", "Growth Profitability and Financial Ratios for ACME\nKey Financials USD\n"
                          ",2016-12,2017-12,TTM\n\"Revenue USD Mil\",\"1,000\",2000,\n")
    out = CSV.read_sheets(spark, d, 2)
    got = rows(out, "Symbol", "item", "label", "period", "value")
    assert got == [("ACME", "Revenue USD Mil", "", "2016-12", 1000.0), ("ACME", "Revenue USD Mil", "", "2017-12", 2000.0),
                   ("ACME", "Revenue USD Mil", "", "TTM", None)]


def _with_splits(spark, size, fn):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "4096")
    try:
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_rows_and_pos_do_not_depend_on_splits(spark):
    d = tempfile.mkdtemp(prefix="tl-splits-")
    _write(d, "BIG.csv", "title\n\nFiscal year,2015,2016\n" + "".join(f"item {i},{i},{i + 1}\n\n" for i in range(4000)))
    _write(d, "LATE.csv", "title " + "x" * 40000 + "\nFiscal year,2015\nonly,1\n")  # the header is in a later split
    got = [_with_splits(spark, size, lambda: rows(CSV.read_sheets(spark, d, 1))) for size in ("8192", "100000", "128m")]
    assert got[0] == got[1] == got[2] and len(got[0]) == 8001
    orders = [_with_splits(spark, size, lambda: rows(CSV.read_offset_csv(spark, d, 1, "`2016` DOUBLE"))) for size in ("8192", "128m")]
    assert orders[0] == orders[1]


def test_short_and_comma_free_lines_keep_their_cells(spark):
    d = tempfile.mkdtemp(prefix="tl-short-")
    _write(d, "ACME.csv", "t\nFiscal year,2015,2016\nA,1,2\nSection\nB,3\n")
    got = rows(CSV.read_sheets(spark, d, 1), "pos", "item", "period", "value")
    assert got == sorted([(1, "A", "2015", 1.0), (1, "A", "2016", 2.0), (2, "Section", "2015", None), (2, "Section", "2016", None),
                          (3, "B", "2015", 3.0), (3, "B", "2016", None)], key=lambda t: tuple((v is not None, str(v)) for v in t))


def test_cells_go_by_header_name(spark):
    d = tempfile.mkdtemp(prefix="tl-order-")
    _write(d, "A.csv", "t\nDate,Close,High,Low,Open,Extra\n1/2/2020,9,8,7,6,x\n")
    r = CSV.read_offset_csv(spark, d, 1, PRICE_SCHEMA).first()
    assert (r.Open, r.High, r.Low, r.Close, r.Volume) == (6.0, 8.0, 7.0, 9.0, None)
    assert [x.Symbol for x in CSV.header_mismatches(spark, d, 1, ["Date", "Volume"]).collect()] == ["A"]


def test_folder_symbols_stay_text_under_default_inference(spark):
    d = tempfile.mkdtemp(prefix="tl-names-")
    for name in ("007", "1E5", "NA"):
        _write(f"{d}/Symbol={name}", "x.csv", "t\nDate,Open\n1/2/2020,1\n")
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        assert rows(CSV.read_offset_csv(spark, d, 1, "Open DOUBLE"), "Symbol") == [("007",), ("1E5",), ("NA",)]
    finally:
        spark.conf.set(key, old)


def test_very_wide_quoted_lines(spark):
    d = tempfile.mkdtemp(prefix="tl-wide-")
    n = 10_000
    cells = ",".join(f'"{i},0"' for i in range(n))
    _write(d, "W.csv", "t\nFiscal," + ",".join(f"P{i}" for i in range(n)) + f'\n"a ""quoted"" item",{cells}\n' + '"' + '""' * 50_000 + '",1\n')
    out = CSV.read_sheets(spark, d, 1)
    assert out.count() == 2 * n and out.where("item = 'a \"quoted\" item' and value is not null").count() == n


def test_read_listing(spark):
    d = tempfile.mkdtemp(prefix="tl-list-")
    _write(d, "nasdaq.csv", '\ufeff"Symbol","Name","LastSale","MarketCap","industry","Summary Quote",\n'
                            '"AA ","A, Inc","1.015","$1.2B","x","q",\n"NA","N","n/a","n/a","","q",\n')
    out = CSV.read_listing(spark, d)
    assert out.columns == ["Symbol", "Name", "LastSale", "MarketCap", "industry", "Summary Quote", "pos"]
    assert rows(out, "pos", "Symbol", "Name", "MarketCap", "industry") == [(1, "AA ", "A, Inc", "$1.2B", "x"), (2, "NA", "N", "n/a", None)]


def test_hot_key_gets_several_files(spark, monkeypatch):
    from tickerlake.session import shared_dir
    monkeypatch.setattr(CSV, "ROWS_PER_FILE", 100)
    df = spark.range(950).selectExpr("if(id < 900, 'HOT', 'S') as Symbol", "cast(id as string) as Date", "cast(id as double) as Open")
    out = CSV.write_offset_csv(df, shared_dir(spark, "test-hot"), ["Date", "Open"], "t")
    assert len(os.listdir(os.path.join(out.removeprefix("file:"), "Symbol=HOT"))) == 9
    assert rows(CSV.read_offset_csv(spark, out, 1, "Date STRING, Open DOUBLE"), "Symbol", "Date", "Open") == rows(df, "Symbol", "Date", "Open")


def test_listing_files_keep_their_order_over_parts(spark, monkeypatch):
    from tickerlake.operators import clean
    from tickerlake.session import shared_dir
    monkeypatch.setattr(CSV, "ROWS_PER_FILE", 40)
    df = spark.range(130).selectExpr("concat('S ', id % 50) as Symbol", "concat('a \"', id, '\", inc') as Name", "cast(id as string) as LastSale",
                                     "'$1M' as MarketCap", "if(id % 2 = 0, null, 'x') as industry", "'q' as `Summary Quote`", "id as pos").repartition(5)
    out = CSV.write_listing(df, shared_dir(spark, "test-listing"))
    assert len(os.listdir(out.removeprefix("file:"))) >= 4
    back = CSV.read_listing(spark, out)
    assert rows(back, "Symbol", "Name", "LastSale", "MarketCap", "industry") == rows(df, "Symbol", "Name", "LastSale", "MarketCap", "industry")
    assert [r.Name for r in back.orderBy("pos").collect()] == [r.Name for r in df.orderBy("pos").collect()]
    assert rows(clean.listing_clean(back, back.limit(0))) == rows(clean.listing_clean(df, df.limit(0)))


def test_readers_run_no_python(spark):
    d = tempfile.mkdtemp(prefix="tl-plan-")
    _write(d, "A.csv", "t\nDate,Open\n1/2/2020,1\n")
    for df in (CSV.read_offset_csv(spark, d, 1, "Open DOUBLE"), CSV.read_sheets(spark, d, 1), CSV.read_listing(spark, d)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_a_filter_on_the_folder_key_leaves_line_numbers_alone(spark):
    d = tempfile.mkdtemp(prefix="tl-prune-")
    for s in "ABC":
        _write(f"{d}/Symbol={s}", "x.csv", "t\nDate,Open\n" + "".join(f"1/2/2020,{i}\n" for i in range(200)))
    got = CSV.read_offset_csv(spark, d, 1, "Open DOUBLE").where("Symbol = 'B'")
    assert sorted((r["__order"], r["Open"]) for r in got.collect()) == [(i + 2, float(i)) for i in range(200)]


def test_bundles_read_as_the_files_do(spark, monkeypatch):
    from tickerlake.session import shared_dir
    monkeypatch.setattr(CSV, "ROWS_PER_REPORT", 100)
    df = spark.range(950).selectExpr("if(id < 700, 'HOT', if(id = 949, null, concat('S/', id % 40, '.B'))) as Symbol",
                                     "if(id % 50 = 0, concat(char(30), id), concat('a, \"', id)) as Date", "cast(id as double) as Open").repartition(5)
    kinds = "Open DOUBLE, Date STRING, Missing DOUBLE"
    files = CSV.write_offset_csv(df, shared_dir(spark, "test-loose"), ["Date", "Open"], "t")
    bundles = CSV.bundle_offset_csv(df, shared_dir(spark, "test-bundles"), ["Date", "Open"], "t")
    want = rows(CSV.read_offset_csv(spark, files, 1, kinds), "Symbol", "Date", "Open", "Missing")
    assert len(want) == 949
    for size in ("4096", "128m"):
        got = _with_splits(spark, size, lambda: rows(CSV.read_offset_csv(spark, bundles, 1, kinds), "Symbol", "Date", "Open", "Missing"))
        assert got == want
    hot = CSV.read_offset_csv(spark, bundles, 1, kinds).where("Symbol = 'HOT'")
    assert hot.agg({"__order": "min"}).first()[0] == 2 and hot.agg({"__order": "max"}).first()[0] < 200  # 7 reports
    assert CSV.header_mismatches(spark, bundles, 1, ["Date", "Volume"]).where("Symbol = 'HOT'").count() == 1


def test_bundled_sheets_read_as_the_files_do(spark):
    from tickerlake.session import shared_dir
    long = spark.range(600).selectExpr("if(id = 7, null, concat('S.', id % 23)) as Symbol", "if(id % 2 = 0, 'bs', 'cf') as report", "12 as freq", "id % 97 as pos",
                                       "if(id % 97 = 5, concat(char(30), 'x'), concat('item, ', id % 97)) as item", "'Fiscal year' as label",
                                       "concat('20', lpad(id div 97, 2, '0')) as period", "if(id % 5 = 0, null, cast(id as double)) as value")
    for short in (False, True):
        files = CSV.write_sheets(long, shared_dir(spark, "test-loose"), short=short)
        bundles = CSV.bundle_sheets(long, shared_dir(spark, "test-bundles"), short=short)
        want = rows(CSV.read_sheets(spark, files, 1))
        assert len(want) > 599 and rows(CSV.read_sheets(spark, bundles, 1)) == want


def test_a_bundle_keeps_blank_lines_and_titles_apart(spark):
    d = tempfile.mkdtemp(prefix="tl-bundle-")
    _write(d, "b.txt", f"{CSV.MARK}BRK.B\n\nKey ratios\r\nUSD\n\n,2016,2017\r\n\nRevenue,\"1,000\"\nSection\n{CSV.MARK}NONE\ntitle\n{CSV.MARK}ONE\nt\nt\n,2018\nx,1")
    got = rows(CSV.read_sheets(spark, CSV.Bundles(d), 2), "Symbol", "pos", "item", "period", "value")
    assert got == [("BRK.B", 1, "Revenue", "2016", 1000.0), ("BRK.B", 1, "Revenue", "2017", None), ("BRK.B", 2, "Section", "2016", None),
                   ("BRK.B", 2, "Section", "2017", None), ("ONE", 1, "x", "2018", 1.0)]


def test_files_of_report_queries_do_not_grow_with_symbols(spark):
    """A file per symbol, or per sheet, cost more time than all rows together."""
    from tickerlake.plans import registry
    d = tempfile.mkdtemp(prefix="tl-many-")
    spark.range(3000).selectExpr("id as l_partkey", "1 as l_linenumber", "1.0D as l_quantity", "2.0D as l_extendedprice", "0.1D as l_discount", "0.0D as l_tax", "'A' as l_returnflag",
                                 "'F' as l_linestatus", "timestamp_ntz '1995-01-02 00:00:00' as l_shipdate").write.parquet(f"{d}/lineitem.parquet")
    spark.range(3000).selectExpr("id as o_orderkey", "id as o_custkey", "'F' as o_orderstatus", "1.0D as o_totalprice", "timestamp_ntz '1995-01-02 00:00:00' as o_orderdate",
                                 "'1-URGENT' as o_orderpriority").write.parquet(f"{d}/orders.parquet")
    for name in ("read_offset_csv", "read_reordered_csv", "read_sheets", "read_short_sheets"):
        out = registry.QUERIES[name](spark, d)
        assert len(out.inputFiles()) < 100
        assert (out.count(), out.select("Symbol").distinct().count()) == (3000, 3000)
