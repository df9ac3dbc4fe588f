"""Market-shaped entry points on small landed files with the dirty cases of
FIXTURES.md (codes without zeros, header lines as data, missing values,
duplicate keys, error replies, zero previous close, junk prices)."""

import pytest

from bourse.plans import markets as M


def land(spark, path, header, rows, header_lines=1, encoding=None):
    text = [",".join(header)] * header_lines + [
        ",".join("" if v is None else str(v) for v in r) for r in rows]
    w = spark.createDataFrame([(t,) for t in text], "value string").coalesce(1).write
    if encoding:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
        w = w.option("encoding", encoding).format("csv").option("quote", "\u0000")
        w.save(path)
    else:
        w.text(path)
    return path


KRX_LIST_HEADER = ["Code", "ISU_CD", "Name", "Market", "Dept", "Close", "ChangeCode",
                   "Changes", "ChangesRatio", "Open", "High", "Low", "Volume", "Amount",
                   "Marcap", "Stocks", "MarketId"]


def _krx_row(code, name, market):
    return [code, "KR7" + str(code), name, market, "", 100, 1, 2, 0.5, 99, 101, 98, 1000,
            100000, 5000000, 50000, "STK"]


@pytest.fixture()
def krx(spark, tmp_base):
    listing = M.krx_list(spark, land(spark, f"{tmp_base}/l", KRX_LIST_HEADER, [
        _krx_row("5930", "Samsung", "KOSPI"), _krx_row("660", None, "KOSPI"),
        KRX_LIST_HEADER, _krx_row("35420", "Naver", "KOSDAQ GLOBAL"),
        _krx_row("91990", "Celltrion", "KOSDAQ"), _krx_row("111111", "Odd", "XYZ")]),
        f"{tmp_base}/krx_list")
    info = M.krx_co_info(spark, land(spark, f"{tmp_base}/i", list(M.KRX_CO_INFO_TYPES), [
        ["5930", "Samsung", "KOSPI", "Tech", "Chips", "1975-06-11", "12", "Lee", "x", "Seoul"],
        ["35420", "Naver", "KOSDAQ", None, "Web", "2002-10-29", "12", "Choi", "y", "Seoul"]]),
        f"{tmp_base}/krx_co_info")
    bars = M.krx_stock(spark, land(spark, f"{tmp_base}/s", M.KRX_STOCK_LANDED, [
        ["2024-01-02", None, None, None, None, None, None, "5930"],
        ["2024-01-03", 10, 12, 9, 11, 500, 0.1, "5930"],
        ["2024-01-04", None, None, None, None, None, None, "5930"],
        ["2024-02-01", 12, 13, 11, 12, 700, 0.1, "5930"],
        [None, 1, 1, 1, 1, 1, 0, "5930"],
        ["2024-01-03", 20, 21, 19, 20, 100, 0.0, "91990"],
        ["2024-01-03", 5, 5, 5, 5, 5, 0.0, "222222"]]),
        f"{tmp_base}/krx_stock", listing=listing, start="2020-01-01")
    return listing, info, bars


def test_krx_loads(krx):
    listing, info, bars = krx
    assert sorted(r.Code for r in listing.collect()) == ["005930", "035420", "091990", "111111"]
    assert [r.Code for r in info.collect()] == ["005930"]          # NULL sector dropped
    rows = {(r.Code, str(r.Date)[:10]): r.Close for r in bars.collect()}
    assert rows[("005930", "2024-01-02")] is None                  # leading gap stays
    assert rows[("005930", "2024-01-04")] == 11                    # filled inside
    assert ("222222", "2024-01-03") not in rows                    # not listed
    assert bars.schema["Close"].dataType.typeName() == "long"


def test_krx_by_market(spark, tmp_base, krx):
    listing, info, bars = krx
    table, rejects = M.krx_list_by_market(spark, listing, info, f"{tmp_base}/lbm")
    groups = {r.code: r.market_group for r in table.collect()}
    assert groups == {"005930": "kospi", "035420": "kosdaq", "091990": "kosdaq"}
    assert [r.code for r in rejects.collect()] == ["111111"]
    assert table.filter("code = '035420'").first().sector is None  # listed, no info
    stock, _ = M.krx_stock_by_market(spark, bars, listing, f"{tmp_base}/sbm")
    assert {r.market_group for r in stock.collect()} == {"kospi", "kosdaq"}
    by_code = M.stock_by_symbol(spark, bars, "Code", f"{tmp_base}/sbc", narrow=M.KRX_BY_CODE)
    assert by_code.schema["close"].dataType.typeName() == "integer"
    names = listing.select("Code", "Name")
    rep = M.next_close_report(spark, bars, "Code", f"{tmp_base}/fc", symbols=names, label="Name")
    assert rep.count() <= 1 and set(rep.columns) >= {"index", "symbol", "tomorrow_close"}


def test_nasdaq_loads(spark, tmp_base):
    nl = M.nas_list(spark, land(spark, f"{tmp_base}/nl", list(M.NAS_LIST_TYPES), [
        ["AAPL", "Apple", "Tech", "1"], ["NA", "Nautilus", "Ships", "2"],
        ["AAPL", "Apple again", "Tech", "1"]], header_lines=2), f"{tmp_base}/nas_list")
    got = {r.Symbol: r.Name for r in nl.collect()}
    assert got == {"AAPL": "Apple", "NA": "Nautilus"}
    ns = M.nas_stock(spark, land(spark, f"{tmp_base}/ns", M.NAS_STOCK_LANDED, [
        ["2024-01-02", 1, 2, 0.5, 1.5, 1.5, 100, "AAPL"],
        ["2024-01-02", 9, 9, 9, 9, 9, 9, "AAPL"],
        ["2024-01-03", 2, 3, 1, 2.5, 2.5, 200, "AAPL"]]), f"{tmp_base}/nas_stock")
    assert sorted((str(r.Date), r.Close) for r in ns.collect()) == \
        [("2024-01-02", 1.5), ("2024-01-03", 2.5)]


def test_overview_and_snapshot(spark, tmp_base):
    ok = ('{"Symbol": "AAPL", "AssetType": "Common Stock", "Name": "Apple", '
          '"Description": "phones", "CIK": "320193", "Exchange": "NASDAQ"}')
    replies = spark.createDataFrame([("AAPL", ok), ("MSFT", '{"Error Message": "limit"}')],
                                    "symbol string, reply string")
    table, errors = M.company_overview(spark, replies, f"{tmp_base}/ov")
    assert len(table.columns) == 45 and "Description" not in table.columns
    assert [(r.Symbol, r.CIK) for r in table.collect()] == [("AAPL", "320193")]
    assert [r.error_message for r in errors.collect()] == ["limit"]
    quotes = spark.createDataFrame([
        ("A", "Alpha", "Tech", 300.0, 10.0, 100.0, 101.0),
        ("B", "Beta", "Tech", None, 10.0, 50.0, 49.0),
        ("C", None, "Tech", 500.0, 10.0, 10.0, 11.0),
        ("D", "Delta", "Tech", 900.0, 10.0, 0.0, 1.0)],
        "symbol string, shortName string, sector string, marketCap double, volume double, "
        "previousClose double, regularMarketOpen double")
    snap, bad = M.market_snapshot(spark, quotes, f"{tmp_base}/snap")
    rows = {r.symbol: r.changesratio for r in snap.collect()}
    assert rows == {"A": 1.0, "B": -2.0}
    assert [r.symbol for r in bad.collect()] == ["D"]
    assert list(snap.columns) == list(M.SNAPSHOT_TABLE_TYPES)


def test_snp_loads(spark, tmp_base):
    sl = M.snp_list(spark, land(spark, f"{tmp_base}/sl", list(M.SNP_LIST_TYPES), [
        ["MMM", "3M", "Industrials", "Industrial Conglomerates"],
        ["XYZ", "Xyz", None, "None"]]), f"{tmp_base}/snp_list")
    assert [r.Symbol for r in sl.collect()] == ["MMM"]
    ss = M.snp_stock(spark, land(spark, f"{tmp_base}/ss", M.SNP_STOCK_LANDED, [
        ["2024-01-02", 10, 11, 9, 10, 100, "MMM"],
        ["2024-01-02", 10, 11, 9, 10, 100, "MMM"],
        ["2024-01-03", 11, 12, 10, 12, 100, "MMM"],
        ["2024-01-04", "abc", 12, 10, 12, 100, "MMM"],
        ["2024-01-02", 5, 5, 5, 5, 5, "AAA"]]), f"{tmp_base}/snp_stock", start="2023-01-01")
    got = {(r.Symbol, str(r.Date)[:10]): r.Change for r in ss.collect()}
    assert got == {("MMM", "2024-01-02"): 0.0, ("MMM", "2024-01-03"): 0.2,
                   ("AAA", "2024-01-02"): 0.0}


def test_materials(spark, tmp_base):
    gold = land(spark, f"{tmp_base}/gold", [], [
        ["2024-01-02", 1, 2, 3, 4, 5, 6], ["2024-01-03", 1, None, 3, 4, 5, 6],
        ["1990-01-02", 1, 2, 3, 4, 5, 6]], header_lines=0, encoding="cp949")
    out = M.materials(spark, {"gold_price": gold}, f"{tmp_base}/mat")
    rows = sorted(str(r.date) for r in out["gold_price"].collect())
    assert rows == ["2024-01-02"]          # missing USD_PM dropped, 1990 out of 20 years


def test_daily_krx_chain(spark, tmp_base):
    from bourse.plans.daily import run_krx_day
    landed = {
        "krx_list": land(spark, f"{tmp_base}/l", KRX_LIST_HEADER, [
            _krx_row("5930", "Samsung", "KOSPI"), _krx_row("91990", "Celltrion", "KOSDAQ")]),
        "krx_co_info": land(spark, f"{tmp_base}/i", list(M.KRX_CO_INFO_TYPES), [
            ["5930", "Samsung", "KOSPI", "Tech", "Chips", "1975-06-11", "12", "Lee", "x",
             "Seoul"]]),
        "krx_stock": land(spark, f"{tmp_base}/s", M.KRX_STOCK_LANDED, [
            [f"2024-01-{d:02d}", 10 + d, 11 + d, 9 + d, 10 + d + d % 3, 100 * d, 0.0, code]
            for d in range(2, 20) for code in ("5930", "91990")]),
    }
    out = run_krx_day(spark, landed, f"{tmp_base}/day", start="2020-01-01")
    assert out["krx_stock"].count() == 36
    assert out["list_by_market"].count() == 2 and out["list_rejects"].count() == 0
    assert {r.market_group for r in out["stock_by_market"].collect()} == {"kospi", "kosdaq"}
    assert sorted(r.symbol for r in out["forecast"].collect()) == ["Celltrion", "Samsung"]


def test_daily_snp_chain(spark, tmp_base):
    from bourse.plans.daily import run_snp_day
    landed = {
        "snp_list": land(spark, f"{tmp_base}/l", list(M.SNP_LIST_TYPES), [
            ["MMM", "3M", "Industrials", "Industrial Conglomerates"]]),
        "snp_stock": land(spark, f"{tmp_base}/s", M.SNP_STOCK_LANDED, [
            [f"2024-01-{d:02d}", 10 + d, 11 + d, 9 + d, 10 + d * 1.5, 100 + d, "MMM"]
            for d in range(2, 25)]),
    }
    out = run_snp_day(spark, landed, f"{tmp_base}/day")
    assert out["snp_stock"].count() == 23
    assert out["stock_by_symbol"].schema["date"].dataType.typeName() == "date"
    rep = out["forecast"].collect()
    assert len(rep) == 1 and rep[0].direction == "up"


def test_daily_nas_chain(spark, tmp_base):
    from bourse.plans.daily import run_nas_day
    landed = {
        "nas_list": land(spark, f"{tmp_base}/l", list(M.NAS_LIST_TYPES), [
            ["AAPL", "Apple", "Tech", "1"], ["AAPL", "Apple dup", "Tech", "1"]]),
        "nas_stock": land(spark, f"{tmp_base}/s", M.NAS_STOCK_LANDED, [
            [f"2024-02-{d:02d}", 10 + d, 11 + d, 9 + d, 10 + d * 0.5, 10 + d * 0.5, 100 + d,
             "AAPL"] for d in range(1, 20)]),
    }
    out = run_nas_day(spark, landed, f"{tmp_base}/day")
    assert [r.Name for r in out["nas_list"].collect()] == ["Apple"]
    assert out["nas_stock"].count() == 19 and out["stock_by_symbol"].count() == 19
    rep = out["forecast"].collect()
    assert len(rep) == 1 and rep[0].symbol == "AAPL" and rep[0].direction == "up"


def test_text_loads_read_quoted_line_breaks(spark, tmp_path, tmp_base):
    """Names and descriptions as landed text holds them."""
    name = '"Two\nlines, ""quoted"""'
    def land_text(file, header, row):
        (tmp_path / file).write_text(",".join(header) + "\n" + ",".join(row) + "\n")
        return str(tmp_path / file)
    want = 'Two\nlines, "quoted"'
    row = [str(x) for x in _krx_row("5930", name, "KOSPI")]
    assert [r.Name for r in M.krx_list(spark, land_text("l.csv", KRX_LIST_HEADER, row), f"{tmp_base}/l").collect()] == [want]
    info = ["5930", name, "KOSPI", "Tech", name, "1975-06-11", "12", "Lee", "x", "Seoul"]
    got = M.krx_co_info(spark, land_text("i.csv", list(M.KRX_CO_INFO_TYPES), info), f"{tmp_base}/i").collect()
    assert [(r.Name, r.Industry) for r in got] == [(want, want)]
    got = M.nas_list(spark, land_text("n.csv", list(M.NAS_LIST_TYPES), ["AAPL", name, "Tech", "1"]), f"{tmp_base}/n").collect()
    assert [r.Name for r in got] == [want]
    got = M.snp_list(spark, land_text("s.csv", list(M.SNP_LIST_TYPES), ["MMM", name, "I", "C"]), f"{tmp_base}/s").collect()
    assert [r.Name for r in got] == [want]
