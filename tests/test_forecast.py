"""Forecast: features against a pandas rendering of the reference's per-symbol
steps, and the per-symbol fits against numpy closed forms (brute force on the
smallest fixture)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from bourse.operators.forecast import (FEATURES, feature_frame, fit_linear, forecast_linear,
                                       forecast_report, forecast_ridge, mse)
from bourse.plans import adapters as A

SF = "/root/testdata/sf0.001"


def _pandas_features(bars: pd.DataFrame) -> pd.DataFrame:
    out = []
    for sym, data in bars.groupby("symbol"):
        data = data.sort_values("date").copy()
        data["daily_return"] = data["close"].pct_change()
        data = data.dropna()
        vol = data["volume"].astype(float)
        sd = vol.std(ddof=0)
        data["volume_z"] = 0.0 if sd == 0 else (vol - vol.mean()) / sd
        data["label"] = data["close"].shift(-1)
        out.append(data)
    return pd.concat(out)


def test_feature_frame_matches_pandas(spark):
    bars = A.bars(spark, SF)
    exp = _pandas_features(bars.toPandas())
    got = feature_frame(bars).toPandas()
    m = exp.merge(got, on=["symbol", "date"], suffixes=("_e", "_g"))
    assert len(m) == len(exp) == len(got)
    for c in ["daily_return", "volume_z"]:
        assert np.allclose(m[f"{c}_e"], m[f"{c}_g"], atol=1e-9)
    assert ((m["label_e"].isna() & m["label_g"].isna()) |
            np.isclose(m["label_e"], m["label_g"])).all()


def test_linear_and_ridge_match_numpy(spark):
    feats = feature_frame(A.bars(spark, SF))
    pdf = feats.toPandas()
    lin = {r.symbol: r for r in forecast_linear(feats).collect()}
    ridge = {r.symbol: r for r in forecast_ridge(feats, lam=1.0).collect()}
    checked = 0
    for sym, g in pdf.groupby("symbol"):
        g = g.sort_values("date")
        train = g[g["label"].notna()]
        last = g.iloc[-1]
        if len(train) >= 2 and train["close"].nunique() > 1:
            slope, icpt = np.polyfit(train["close"], train["label"], 1)
            assert np.isclose(lin[sym].tomorrow_close, icpt + slope * last["close"], rtol=1e-7)
        if len(train) >= 1:
            x = np.column_stack([np.ones(len(train))] + [train[c] for c in FEATURES])
            pen = np.eye(x.shape[1])
            pen[0, 0] = 0.0
            beta = np.linalg.solve(x.T @ x + pen, x.T @ train["label"].to_numpy())
            pred = np.r_[1.0, last[FEATURES].to_numpy(dtype=float)] @ beta
            assert np.isclose(ridge[sym].tomorrow_close, pred, rtol=1e-6), sym
            checked += 1
    assert checked > 0


def test_report_and_mse(spark):
    feats = feature_frame(A.bars(spark, SF))
    rep = forecast_report(forecast_linear(feats)).orderBy("index").collect()
    assert [r["index"] for r in rep] == list(range(1, len(rep) + 1))
    assert [r.symbol for r in rep] == sorted(r.symbol for r in rep)
    assert {r.direction for r in rep} <= {"up", "down"}
    df = feats.withColumn("yhat", F.col("close"))
    m = {r.symbol: r.mse for r in mse(df.filter("label is not null"), "symbol", "label", "yhat")
         .collect()}
    pdf = df.toPandas().dropna(subset=["label"])
    for sym, g in pdf.groupby("symbol"):
        assert np.isclose(m[sym], ((g["label"] - g["yhat"]) ** 2).mean())


def test_keys_that_share_a_name_are_fitted_apart(spark):
    rows = [(code, f"2024-01-{d:02d}", float(v)) for code, values in (("1", [10, 11, 13, 12, 12]), ("2", [900, 910, 930, 905, 916]))
            for d, v in enumerate(values, 1)]
    bars = spark.createDataFrame(rows, "symbol string, date string, close double").selectExpr(
        "symbol", "to_date(date) AS date", "close AS open", "close AS high", "close AS low", "close", "close * 10 AS volume")
    names = spark.createDataFrame([("1", "Same"), ("2", "Same")], "symbol string, name string")
    rep = forecast_report(forecast_linear(feature_frame(bars)), labels=names).orderBy("index").collect()
    assert [(r["index"], r.symbol) for r in rep] == [(1, "Same"), (2, "Same")]
    assert rep[0].tomorrow_close < 20 and rep[1].tomorrow_close > 800


def test_ridge_has_no_python_on_the_data_path(spark):
    plan = forecast_ridge(feature_frame(A.bars(spark, SF)))._jdf.queryExecution().executedPlan().toString()
    assert "InPandas" not in plan and "Arrow" not in plan and "Python" not in plan


def test_a_function_of_per_key_statistics(spark):
    from bourse.operators.forecast import per_key_apply
    stats = spark.createDataFrame([("a", 1.0, 3.0), ("b", 4.0, 4.0)], "k string, lo double, hi double")
    out = per_key_apply(stats, lambda pdf: pdf.assign(span=pdf.hi - pdf.lo)[["k", "span"]], "k string, span double")
    assert sorted(map(tuple, out.collect())) == [("a", 2.0), ("b", 0.0)]


def _odd_bars(spark, n=4000, seed=7):
    """Bars with gaps of months, missing and zero prices, NaN, one-row symbols,
    constant series and rows without symbol."""
    rng = np.random.default_rng(seed)
    rows, seen = [], set()
    for _ in range(n):
        s, d = int(rng.integers(0, 25)), int(rng.integers(0, 900))
        if (s, d) in seen or (s == 3 and d > 200):
            continue
        seen.add((s, d))
        close = float(rng.choice([0.0, 5.0, 1e6 + rng.normal(), rng.normal() * 10 + 50]))
        row = [None if s == 4 else f"s{s}", d, 1.0, 2.0, 0.5, 7.0 if s == 5 else close, float(rng.integers(1, 9)) if s != 6 else 3.0]
        bad = int(rng.integers(0, 60))
        if bad < 5:
            row[2 + bad] = None
        if bad == 6:
            row[5] = float("nan")
        rows.append(tuple(row))
    rows += [("one", 10, 1.0, 1.0, 1.0, 1.0, 1.0), ("two", 10, 1.0, 1.0, 1.0, 1.0, 1.0), ("two", 400, 1.0, 1.0, 1.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, d int, open double, high double, low double, close double, volume double")
    return df.selectExpr("symbol", "date_add(DATE '2020-01-01', d) AS date", "open", "high", "low", "close", "volume")


def _by_key(rows, cols):
    return {tuple(r[c] for c in ("symbol", "date") if c in r.__fields__): [r[c] for c in cols] for r in rows}


def _same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None) == (y is None) and (x is None or np.isclose(x, y, rtol=1e-7, atol=1e-7)), (k, a[k], b[k])


def test_segments_do_not_change_features_or_fit(spark):
    bars = _odd_bars(spark)
    cols = ["open", "close", "volume_z", "daily_return", "label"]
    whole = feature_frame(bars, segment=None)
    want = _by_key(whole.collect(), cols)
    for segment in ("month", "day", "year", "range"):
        _same(_by_key(feature_frame(bars, segment=segment).collect(), cols), want)
    fit_cols = ["slope", "intercept", "n_train", "today_close", "tomorrow_close"]
    want_fit = _by_key(forecast_linear(whole).collect(), fit_cols)
    labelled = whole.filter("label is not null").join(forecast_linear(whole).select("symbol", "slope", "intercept"), "symbol")
    want_mse = {r.symbol: r.mse for r in mse(labelled.withColumn("yhat", F.expr("intercept + slope * close")), "symbol", "label", "yhat").collect()}
    for segment in (None, "month", "day", "year"):
        got = fit_linear(bars, segment=segment).collect()
        _same(_by_key(got, fit_cols), want_fit)
        for r in got:
            e = want_mse.get(r.symbol)
            assert (e is None) == (r.mse is None) and (e is None or np.isclose(r.mse, e, rtol=1e-6, atol=1e-6))
    assert any(r.n_train == 0 for r in fit_linear(bars).collect())


def test_features_agree_with_pandas_on_odd_bars(spark):
    pdf = _odd_bars(spark).toPandas().dropna(subset=["symbol"])
    exp = []
    for _, g in pdf.groupby("symbol"):
        g = g.sort_values("date").copy()
        before = g["close"].shift(1)
        g["daily_return"] = ((g["close"] - before) / before.where(before != 0)).astype(float)
        g = g.dropna()
        sd = g["volume"].std(ddof=0)
        g["volume_z"] = 0.0 if sd == 0 else (g["volume"] - g["volume"].mean()) / sd
        g["label"] = g["close"].shift(-1)
        exp.append(g)
    exp = pd.concat(exp)
    got = feature_frame(_odd_bars(spark)).toPandas()
    m = exp.merge(got, on=["symbol", "date"], suffixes=("_e", "_g"))
    assert len(m) == len(exp) == len(got)
    for c in ("daily_return", "volume_z", "label"):
        assert np.allclose(m[f"{c}_e"].astype(float), m[f"{c}_g"].astype(float), atol=1e-9, equal_nan=True)


def test_features_and_fit_in_few_exchanges(spark):
    def executed(df):
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    bars = A.bars(spark, SF)          # itself one exchange
    plan = executed(feature_frame(bars))
    # bars, by (key, month), summary to its key, and back
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") <= 4, plan
    plan = executed(fit_linear(bars))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") <= 3, plan
    assert "Join" not in plan
