"""Round trips for the landed-file scans and the table writes."""

import os

import pytest
from pyspark.sql import functions as F

from bourse.operators.keys import KeyViolation
from bourse.sinks import (append_rows, market_groups, partition_view, publish,
                          read_rejects, read_table, refresh_table, write_csv,
                          write_market_partitioned, write_partitioned,
                          write_per_value_files)
from bourse.sinks.tables import BUCKET
from bourse.sources import (scan_csv, scan_csv_positional, scan_json_records,
                            scan_symbol_files, scan_table, split_rejects)

from pyspark.sql import types as T


def _frame(spark):
    return spark.createDataFrame(
        [("005930", "Samsung", "KOSPI", 1.5), ("000660", "SK", "KOSDAQ", None),
         ("NA", "Ticker NA", "KONEX", 2.0), ("035420", "N/A", "KOSDAQ GLOBAL", 3.0)],
        "code string, name string, market string, marcap double")


def test_csv_header_roundtrip_keeps_zeros_and_na_symbol(spark, tmp_base):
    df = _frame(spark)
    write_csv(df, tmp_base)
    back = scan_csv(spark, tmp_base, df.columns, keep_text=["code"])
    rows = {r.code: r for r in back.collect()}
    assert set(rows) == {"005930", "000660", "NA", "035420"}      # 'NA' is a symbol
    assert rows["035420"].name is None                             # 'N/A' is missing
    assert rows["000660"].marcap is None


def test_positional_bom_and_cp949(spark, tmp_base):
    df = _frame(spark).withColumn("name", F.concat("name", F.lit(" 주식")))
    write_csv(df, f"{tmp_base}/bom", bom=True)
    write_csv(df, f"{tmp_base}/kr", encoding="cp949", header=False)
    a = scan_csv(spark, f"{tmp_base}/bom", df.columns, keep_text=["code"])
    b = scan_csv_positional(spark, f"{tmp_base}/kr", df.columns, encoding="cp949")
    assert sorted(r.name for r in a.collect()) == sorted(r.name for r in df.collect())
    assert sorted(r.name for r in b.collect()) == sorted(r.name for r in df.collect())
    # the bytes on disk are cp949, not UTF-8
    raw = spark.read.text(f"{tmp_base}/kr").collect()
    assert not any("주식" in r.value for r in raw)


def test_symbol_file_set(spark, tmp_base):
    df = spark.createDataFrame([("005930", "2024-01-02", "1.0"), ("000660", "2024-01-02", "2.0"),
                                ("BRK/A", "2024-01-02", "3.0"), ("A+B=C", "2024-01-02", "4.0")],
                               "symbol string, date string, close string")
    write_per_value_files(df, tmp_base, "symbol", ["date"])
    back = scan_symbol_files(spark, tmp_base, ["date", "close"], r"symbol=([^/]+)/")
    assert sorted((r.symbol, r.close) for r in back.collect()) == \
        [("000660", "2.0"), ("005930", "1.0"), ("A+B=C", "4.0"), ("BRK/A", "3.0")]


def test_json_records_split_errors(spark):
    df = spark.createDataFrame([(1, '{"Symbol": "A", "Price": "1.5"}'),
                                (2, '{"Error Message": "limit"}'), (3, "not json"),
                                (4, None), (5, ""), (6, "[]"), (7, "5"), (8, "null")],
                               "id int, reply string")
    schema = T.StructType([T.StructField("Symbol", T.StringType()),
                           T.StructField("Price", T.StringType())])
    good, bad = scan_json_records(df, "reply", schema)
    assert [(r.id, r.Symbol) for r in good.collect()] == [(1, "A")]
    assert sorted((r.id, r.error_message) for r in bad.collect()) == \
        [(2, "limit"), *[(i, "unparsable record") for i in range(3, 9)]]


def test_json_lines_files(spark, tmp_base):
    spark.createDataFrame([('{"Symbol": "A", "Price": "2.5"}',)], "value string") \
        .write.text(tmp_base)
    schema = T.StructType([T.StructField("Symbol", T.StringType()),
                           T.StructField("Price", T.StringType())])
    from bourse.sources import scan_json_files
    assert [(r.Symbol, r.Price) for r in scan_json_files(spark, tmp_base, schema).collect()] == \
        [("A", "2.5")]


def test_refresh_is_all_or_nothing(spark, tmp_base):
    good = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    refresh_table(good, tmp_base, key=["k"], types={"v": "int"})
    dup = spark.createDataFrame([("a", "1"), ("a", "3")], "k string, v string")
    with pytest.raises(KeyViolation):
        refresh_table(dup, tmp_base, key=["k"], types={"v": "int"})
    bad_type = spark.createDataFrame([("c", "x")], "k string, v string")
    with pytest.raises(Exception):
        refresh_table(bad_type, tmp_base, key=["k"], types={"v": "int"})
    kept = read_table(spark, tmp_base)
    assert sorted((r.k, r.v) for r in kept.collect()) == [("a", 1), ("b", 2)]
    from bourse.sinks.tables import _fs
    fs, p = _fs(spark, tmp_base)
    assert len(fs.listStatus(p)) == 1          # failed versions left nothing behind
    newer = spark.createDataFrame([("z", "9")], "k string, v string")
    refresh_table(newer, tmp_base, key=["k"], types={"v": "int"})
    assert [r.k for r in read_table(spark, tmp_base).collect()] == ["z"]


def test_append_and_publish(spark, tmp_base):
    a = spark.range(3)
    append_rows(a, f"{tmp_base}/app")
    append_rows(a, f"{tmp_base}/app")
    assert spark.read.parquet(f"{tmp_base}/app").count() == 6
    publish(a, f"{tmp_base}/pub")
    publish(spark.range(5), f"{tmp_base}/pub")
    assert read_table(spark, f"{tmp_base}/pub").count() == 5


def test_bucketed_layout_and_partition_view(spark, tmp_base):
    rows = [(f"{c:06d}", d, float(c + d)) for c in (5930, 660, 35420, 12) for d in range(5)]
    df = spark.createDataFrame(rows, "code string, day int, close double")
    write_partitioned(df, tmp_base, "code", order=["day"], buckets=8, refresh_key=["code", "day"])
    view = partition_view(spark, tmp_base, "code", "005930")     # knows the table's 8 buckets
    assert sorted(r.day for r in view.collect()) == list(range(5))
    assert all(r.code == "005930" for r in view.collect())
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or f"({BUCKET}" in plan
    assert read_table(spark, tmp_base).schema["code"].dataType == T.StringType()


def test_per_value_layout_keeps_text_keys(spark, tmp_base):
    df = spark.createDataFrame([("005930", 1), ("000660", 2)], "code string, v int")
    write_partitioned(df, tmp_base, "code", per_value=True)
    back = read_table(spark, tmp_base)
    assert sorted(r.code for r in back.collect()) == ["000660", "005930"]


def test_market_groups_cover_input(spark, tmp_base):
    df = _frame(spark).union(
        spark.createDataFrame([("999999", "X", "UNKNOWN", 1.0)], _frame(spark).schema))
    mapping = {"KOSPI": "kospi", "KOSDAQ": "kosdaq", "KOSDAQ GLOBAL": "kosdaq", "KONEX": "konex"}
    routed, rejects = market_groups(df, "market", mapping)
    assert routed.count() + rejects.count() == df.count()
    assert [r.code for r in rejects.collect()] == ["999999"]
    _, rej = write_market_partitioned(df, tmp_base, "market", mapping, key=["code"])
    groups = {r.market_group for r in read_table(spark, tmp_base).collect()}
    assert groups == {"kospi", "kosdaq", "konex"}
    # stored beside the table, with a reason: together they are the input
    stored = read_rejects(spark, tmp_base).collect()
    assert [(r.code, r._reason) for r in stored] == [("999999", "no child for market UNKNOWN")]
    assert read_table(spark, tmp_base).count() + rej.count() == df.count()


def test_table_by_name_follows_refresh(spark, tmp_base):
    from bourse.sinks import register_view
    refresh_table(spark.createDataFrame([("a", 1.0, "x")], "k string, v double, w string"),
                  tmp_base, key=["k"])
    register_view(spark, "bourse_test_t", tmp_base)
    first = scan_table(spark, "bourse_test_t", ["k", "v"])
    assert [tuple(r) for r in first.collect()] == [("a", 1.0)]
    assert "ReadSchema: struct<k:string,v:double>" in \
        first._jdf.queryExecution().executedPlan().toString()
    refresh_table(spark.createDataFrame([("b", 2.0, "y")], "k string, v double, w string"),
                  tmp_base, key=["k"])
    register_view(spark, "bourse_test_t", tmp_base)
    assert [r.k for r in scan_table(spark, "bourse_test_t", ["k"]).collect()] == ["b"]


def test_scan_table_turns_nan_into_null(spark, tmp_base):
    spark.createDataFrame([(1, float("nan")), (2, 3.0)], "k int, v double") \
        .write.parquet(tmp_base)
    got = sorted((r.k, r.v) for r in scan_table(spark, tmp_base).collect())
    assert got == [(1, None), (2, 3.0)]


def test_scan_table_prunes_columns(spark):
    df = scan_table(spark, "/root/testdata/sf0.001/orders.parquet", ["o_orderkey", "o_totalprice"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


ODD = ['plain', 'Foo "Bar", Inc', 'two\nlines', '  pad  ', 'back\\slash\\"q"', '"', ',', "a\n\"b\",\\"]


def test_csv_keeps_every_value(spark, tmp_base):
    df = spark.createDataFrame([(str(i), t, "z") for i, t in enumerate(ODD)], "k string, t string, z string")
    write_csv(df, f"{tmp_base}/h")
    write_csv(df, f"{tmp_base}/p", header=False)
    a = scan_csv(spark, f"{tmp_base}/h", df.columns, multiline=True)
    b = scan_csv_positional(spark, f"{tmp_base}/p", df.columns, multiline=True)
    for back in (a, b):
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_csv_written_by_pandas_reads_the_same(spark, tmp_path):
    import pandas as pd
    rows = pd.DataFrame({"k": [str(i) for i in range(len(ODD))], "t": ODD, "z": "x"})
    rows.to_csv(tmp_path / "h.csv", index=False)
    rows.to_csv(tmp_path / "p.csv", index=False, header=False)
    a = scan_csv(spark, str(tmp_path / "h.csv"), ["k", "t", "z"], multiline=True)
    b = scan_csv_positional(spark, str(tmp_path / "p.csv"), ["k", "t", "z"], multiline=True)
    for back in (a, b):
        assert sorted(map(tuple, back.collect())) == sorted(rows.itertuples(index=False, name=None))


def test_pandas_reads_what_we_write(spark, tmp_path):
    import pandas as pd
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(ODD)], "k string, t string")
    write_csv(df.coalesce(1), str(tmp_path / "out"))
    back = pd.read_csv(next((tmp_path / "out").glob("part-*.csv")), dtype=str)
    assert sorted(back.itertuples(index=False, name=None)) == sorted((str(i), t) for i, t in enumerate(ODD))


def test_header_must_hold_the_names_in_order(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Name,Code,Sector\nA,1,S\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path / "x.csv"), ["Code", "Name", "Sector"]).collect()


def test_ragged_rows_fail_or_go_to_the_rejects(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n1,2,3\n3,c,x,extra\n2,b\n")
    names = ["a", "b", "c"]
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, str(tmp_path / "x.csv"), names).select("a").collect()
    good, bad = split_rejects(scan_csv(spark, str(tmp_path / "x.csv"), names, rejects=True))
    assert [tuple(r) for r in good.collect()] == [("1", "2", "3")]
    assert sorted((r._record, r._reason) for r in bad.collect()) == [("2,b", "wrong number of fields"),
                                                                     ("3,c,x,extra", "wrong number of fields")]


def test_view_of_any_number_of_buckets(spark, tmp_base):
    df = spark.createDataFrame([(f"s{i}", i) for i in range(20)], "code string, v int")
    write_partitioned(df, tmp_base, "code", buckets=16)
    got = [partition_view(spark, tmp_base, "code", f"s{i}").collect() for i in range(20)]
    assert [[r.v for r in x] for x in got] == [[i] for i in range(20)]


def test_json_of_a_wrong_type_is_an_error(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, '{"k": "abc"}'), (3, '{}')], "id int, reply string")
    good, bad = scan_json_records(df, "reply", T.StructType([T.StructField("k", T.LongType())]))
    assert sorted((r.id, r.k) for r in good.collect()) == [(1, 5), (3, None)]
    assert [(r.id, r.error_message) for r in bad.collect()] == [(2, "unparsable record")]


def test_a_reader_sees_a_whole_marker_or_none(spark, tmp_base):
    from bourse.sinks.tables import _fs
    refresh_table(spark.range(3), tmp_base)
    fs, p = _fs(spark, tmp_base)
    version = fs.listStatus(p)[0].getPath()
    names = [s.getPath().getName() for s in fs.listStatus(version)]
    assert "_AUDITED" in names and not [n for n in names if n.endswith(".part")]


# --- one reading of the input for rows and rejects ------------------------------------

@pytest.fixture()
def counted(spark):
    """counted(df): df, and how many of its rows have been computed so far."""
    from pyspark.sql import functions as F
    def make(df):
        seen = spark.sparkContext.accumulator(0)

        def look(x):
            seen.add(1)
            return x
        return df.withColumn("k", F.udf(look, "long")("k")), seen
    return make


def _quotes(spark):
    return spark.range(1000, numPartitions=4).selectExpr(
        "id AS k", "CASE WHEN id % 3 = 0 THEN 'KOSPI' WHEN id % 3 = 1 THEN 'KONEX' ELSE 'X' END AS market", "'t' || id AS t")


def test_a_load_with_rejects_computes_its_input_once(spark, tmp_base, counted):
    df, seen = counted(_quotes(spark))
    mapping = {"KOSPI": "kospi", "KONEX": "konex"}
    _, bad = write_market_partitioned(df, tmp_base, "market", mapping, key=["k"], required=["t"], order=["k"])
    table = read_table(spark, tmp_base)
    assert (table.count(), bad.count()) == (667, 333)
    assert seen.value <= 2000          # the rows and the range sample
    assert table.columns == ["k", "market", "t", "market_group"]
    assert bad.columns == ["k", "market", "t", "market_group", "_reason"]
    assert sorted(r.k for r in bad.collect()) == [i for i in range(1000) if i % 3 == 2]
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "load_refused" in plan


def test_table_and_rejects_change_together(spark, tmp_base):
    mapping = {"KOSPI": "kospi", "KONEX": "konex"}
    write_market_partitioned(_quotes(spark), tmp_base, "market", mapping, key=["k"], order=["k"])
    dup = _quotes(spark).union(_quotes(spark))
    with pytest.raises(KeyViolation):
        write_market_partitioned(dup, tmp_base, "market", mapping, key=["k"], order=["k"])
    assert read_table(spark, tmp_base).count() == 667 and read_rejects(spark, tmp_base).count() == 333
    # a refused row is not held against the key
    refused = _quotes(spark).filter("market = 'X'")
    write_market_partitioned(_quotes(spark).union(refused), tmp_base, "market", mapping, key=["k"], order=["k"])
    assert read_table(spark, tmp_base).count() == 667 and read_rejects(spark, tmp_base).count() == 666


def test_strict_casts_concern_the_table_only(spark, tmp_base):
    from pyspark.sql import functions as F
    from bourse.sinks import refresh_split, rejected
    df = spark.createDataFrame([("1", "2"), ("x", "y")], "a string, b string")
    tagged = df.withColumn("_reason", F.when(F.col("a") == "x", F.lit("not a number")))
    refresh_split(rejected(tagged), tmp_base, key=["a"], types={"a": "int", "b": "int"}, order=["b"])
    assert [tuple(r) for r in read_table(spark, tmp_base).collect()] == [(1, 2)]
    assert [tuple(r) for r in read_rejects(spark, tmp_base).collect()] == [("x", "y", "not a number")]
    with pytest.raises(Exception):
        refresh_split(rejected(df.withColumn("_reason", F.lit(None).cast("string"))), tmp_base, types={"a": "int"})
    assert read_table(spark, tmp_base).count() == 1


def test_split_by_stored_tag_reads_once(spark, counted):
    from pyspark.sql import functions as F
    from bourse.operators import quarantine
    df, seen = counted(_quotes(spark).withColumn("refused", F.lit("own")))
    good, bad = quarantine(df, {"no child": F.col("market") != "X", "small": F.col("k") > 10})
    assert (good.count(), bad.count(), good.count()) == (659, 341, 659)
    assert seen.value == 1000 and good.columns == df.columns and bad.columns == [*df.columns, "_reason"]
    assert good.unionByName(bad.drop("_reason")).exceptAll(_quotes(spark).withColumn("refused", F.lit("own"))).count() == 0


def test_json_replies_are_parsed_once(spark, counted):
    from pyspark.sql import functions as F
    df, seen = counted(_quotes(spark))
    reply = F.when(F.col("market") == "X", F.lit('{"Error Message": "limit"}')).otherwise(F.to_json(F.struct(F.col("k").alias("n"))))
    good, bad = scan_json_records(df.withColumn("reply", reply), "reply", T.StructType([T.StructField("n", T.LongType())]))
    assert (good.count(), bad.count()) == (667, 333) and seen.value == 1000
    assert good.filter("n = k").count() == 667


def test_snapshot_and_overview_read_their_input_once(spark, tmp_base, counted):
    from pyspark.sql import functions as F
    from bourse.plans import markets as M
    quotes, seen = counted(spark.range(1000).selectExpr(
        "id AS k", "'n' || id AS shortName", "'s' AS sector", "CAST(id AS DOUBLE) AS marketCap", "1.0D AS volume",
        "CAST(id % 4 AS DOUBLE) AS previousClose", "1.5D AS regularMarketOpen"))
    table, bad = M.market_snapshot(spark, quotes.withColumn("symbol", F.col("k").cast("string")), f"{tmp_base}/s")
    assert (table.count(), bad.count()) == (750, 250) and seen.value <= 2000
    rows, seen = counted(spark.range(1000).selectExpr("id AS k"))
    reply = F.when(F.col("k") % 5 == 0, F.lit("junk")).otherwise(
        F.to_json(F.struct(F.col("k").cast("string").alias("Symbol"), F.lit("d").alias("Description"))))
    table, bad = M.company_overview(spark, rows.withColumn("reply", reply), f"{tmp_base}/o")
    assert (table.count(), bad.count()) == (800, 200) and seen.value == 1000
    assert bad.columns == ["request_k", "error_message"]


# --- keys checked on the way to sorted files ---------------------------------------------

def _days(spark, n=400):
    return spark.range(n, numPartitions=5).selectExpr("concat('s', lpad(id % 20, 2, '0')) AS code", "date_add(DATE '2024-01-01', CAST(id DIV 20 AS INT)) AS date",
                                                      "CAST(id AS DOUBLE) AS close", "IF(id % 2 = 0, 'KOSPI', 'KONEX') AS market")


def test_sorted_table_is_checked_without_another_read(spark, tmp_base, monkeypatch):
    from bourse.sinks import tables

    def no_audit(*a, **k):
        raise AssertionError("the written files were read again")
    monkeypatch.setattr(tables, "assert_key", no_audit)
    refresh_table(_days(spark), f"{tmp_base}/sorted", key=["date", "code"], required=["close"], order=["code", "date"])
    assert read_table(spark, f"{tmp_base}/sorted").count() == 400
    write_partitioned(_days(spark), f"{tmp_base}/buckets", "code", order=["date"], refresh_key=["date", "code"], buckets=4)
    write_partitioned(_days(spark), f"{tmp_base}/values", "code", order=["date"], refresh_key=["date", "code"], per_value=True)
    write_market_partitioned(_days(spark), f"{tmp_base}/markets", "market", {"KOSPI": "a", "KONEX": "b"},
                             key=["date", "code", "market"], required=["close"], order=["code", "date"])
    for t in ("buckets", "values", "markets"):
        assert read_table(spark, f"{tmp_base}/{t}").count() == 400
    with pytest.raises(AssertionError):       # not sorted by its key: audited on the files
        refresh_table(_days(spark), f"{tmp_base}/plain", key=["date", "code"])


def test_the_check_needs_no_exchange(spark):
    from bourse.sinks.tables import _checked
    ranged = _days(spark).repartitionByRange("code", "date")
    plan = _checked(ranged, ["code", "date"], ["date", "code"], []).sortWithinPartitions("code", "date") \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" in plan


@pytest.mark.parametrize("planted", ["('s07', DATE '2024-01-09', 1.0D, 'KONEX')", "('s00', DATE '2024-01-01', 1.0D, 'KOSPI')",
                                     "('s19', DATE '2024-01-20', 1.0D, 'KONEX')", "('s03', CAST(NULL AS DATE), 1.0D, 'KONEX')",
                                     "('s99', DATE '2024-01-20', CAST(NULL AS DOUBLE), 'KOSPI')"])
def test_a_planted_violation_fails_wherever_ranges_end(spark, tmp_base, planted):
    bad = _days(spark).unionByName(spark.sql(f"SELECT * FROM VALUES {planted} AS t(code, date, close, market)"))
    for name, write in {
            "sorted": lambda df, b: refresh_table(df, b, key=["date", "code"], required=["close"], order=["code", "date"]),
            "markets": lambda df, b: write_market_partitioned(df, b, "market", {"KOSPI": "a", "KONEX": "b"}, required=["close"],
                                                              key=["date", "code", "market"], order=["code", "date"])}.items():
        write(_days(spark), f"{tmp_base}/{name}")
        for parts in (1, 7):
            with pytest.raises(KeyViolation):
                write(bad.repartition(parts), f"{tmp_base}/{name}")
        assert read_table(spark, f"{tmp_base}/{name}").count() == 400


def test_a_key_that_does_not_decide_the_partition_is_audited_on_the_files(spark, tmp_base):
    from pyspark.sql import functions as F
    twice = _days(spark).unionByName(_days(spark).withColumn("market", F.lit("OTHER")))
    with pytest.raises(KeyViolation):
        refresh_table(twice, tmp_base, key=["date", "code"], partition_by=["market"], order=["code", "date"])


def tasks_of(spark, name, read):
    """Tasks of the Spark jobs that ``read`` starts, job by job."""
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        read()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    tracker = sc.statusTracker()
    return [sum(tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(name)]


@pytest.mark.parametrize("layout", ["files", "table"])
def test_many_folders_are_listed_by_few_tasks(spark, tmp_base, layout):
    df = spark.range(100).select(F.col("id").alias("symbol"), F.lit("2024-01-02").alias("date"), F.lit(1.5).alias("close"))
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, found = spark.conf.get(setting), []
    if layout == "files":
        write_per_value_files(df, tmp_base, "symbol", ["date"])
        tasks = tasks_of(spark, tmp_base, lambda: found.append(
            scan_symbol_files(spark, tmp_base, ["date", "close"], r"symbol=([^/]+)/")))
    else:
        write_partitioned(df, tmp_base, "symbol", order=["date"], per_value=True)
        tasks = tasks_of(spark, tmp_base, lambda: found.append(read_table(spark, tmp_base)))
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(setting) == before
    assert sorted(int(r["symbol"]) for r in found[0].collect()) == list(range(100))


# --- a folder for each value: many writers, small files ----------------------------------

def data_files(base):
    return [os.path.join(at, f) for at, _, files in os.walk(base) for f in files if "symbol=" in at]


def test_a_folder_for_each_value_is_written_by_a_few_tasks_a_core(spark, tmp_base):
    df = spark.range(60_000, numPartitions=4).selectExpr("id % 40 AS symbol", "id DIV 40 AS date", "rand(7) AS close", "rand(8) AS low")
    shuffled, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    names = ["spark.sql.adaptive.coalescePartitions.minPartitionNum", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    was, before = spark.conf.get(shuffled), [spark.conf.get(n, None) for n in names]
    spark.conf.set(shuffled, str(16 * cores))
    try:
        write_partitioned(df, tmp_base, "symbol", order=["date"], per_value=True, refresh_key=["date", "symbol"])
    finally:
        spark.conf.set(shuffled, was)
    assert len({os.path.basename(f).split("-")[1] for f in data_files(tmp_base) if f.endswith(".parquet")}) >= 3 * cores
    assert [spark.conf.get(n, None) for n in names] == before
    assert read_table(spark, tmp_base).groupBy("symbol").count().filter("count = 1500").count() == 40


def test_one_file_for_each_value_and_damage_is_still_found(spark, tmp_base):
    df = spark.range(8000).selectExpr("id % 4 AS symbol", "id DIV 4 AS date", "rand(7) AS close")
    write_partitioned(df.coalesce(1), tmp_base, "symbol", order=["date"], per_value=True)
    assert sorted(r.n for r in read_table(spark, tmp_base).groupBy("symbol").agg(F.count("close").alias("n")).collect()) == [2000] * 4
    files = data_files(tmp_base)
    assert {f.split("symbol=")[1].split("/")[0] for f in files} == {"0", "1", "2", "3"}
    assert all(f.endswith(".parquet") and not os.path.basename(f).startswith(".") for f in files)
    with open(files[0], "r+b") as f:      # one bit within a page of ``close``
        f.seek(os.path.getsize(files[0]) // 2)
        byte = f.read(1)[0]
        f.seek(-1, os.SEEK_CUR)
        f.write(bytes([byte ^ 1]))
    with pytest.raises(Exception, match="(?i)checksum|crc"):
        read_table(spark, tmp_base).agg(F.sum("close")).collect()


@pytest.mark.parametrize("kind, keys", [("string", ["005930", "a/b=c", "x%41", "+ 1", "\u00e9 \uc0bc", "{t}", "", None]), ("bigint", [7, -3, 2 ** 40, None])])
def test_keys_come_from_folder_names_without_finding_partitions(spark, tmp_base, kind, keys):
    rows = [(d, k, d + 0.5) for k in keys for d in range(3)]
    df = spark.createDataFrame(rows, f"day int, code {kind}, close double")
    path = write_partitioned(df, tmp_base, "code", order=["day"], per_value=True)
    back = read_table(spark, tmp_base)
    found = spark.read.schema(df.schema).parquet(path)          # Spark's own way
    assert [(f.name, f.dataType, f.metadata) for f in back.schema] == [(f.name, f.dataType, f.metadata) for f in found.schema]
    got, own = ([tuple(r) for r in t.collect()] for t in (back, found))
    assert sorted(got, key=repr) == sorted(own, key=repr) and len(got) == len(rows)
    at = back._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location()
    assert at.partitionSpec().partitions().isEmpty()            # none found, one by one, by the driver
    for k in keys[:3]:
        view = partition_view(spark, tmp_base, "code", k)
        assert sorted(r.day for r in view.collect()) == [0, 1, 2]
        scan = view._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numFiles").value() == 1    # the other values' files are left out
    assert read_table(spark, tmp_base).filter(F.col("code") == F.lit(keys[0])).count() == 3
