"""Series and forecasting against published quarterly numbers and step-by-step recursion."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import forecasting, seasonal_css, series

# Published quarterly totals: label, revenue, profit.
QUARTERS = [
    ("2017-Q4", 16257873, 2438102), ("2018-Q1", 14915388, 2236490), ("2018-Q2", 7582628, 1137044),
    ("2018-Q3", 7246216, 1086576), ("2018-Q4", 21621033, 3242050), ("2019-Q1", 17624008, 2643050),
    ("2019-Q2", 8731858, 1309416), ("2019-Q3", 8343880, 1251267), ("2019-Q4", 25624259, 3842557),
    ("2020-Q1", 30024677, 4502692),
]
# Published forecast: label, revenue, low, high, profit, low, high.
FORECAST = [
    ("2020-Q2", 10348598.56, 9392595.02, 11304602.09, 1551951.89, 1408768.81, 1695134.97),
    ("2020-Q3", 9888784.79, 8975258.85, 10802310.72, 1483032.27, 1346207.71, 1619856.83),
    ("2020-Q4", 30368699.28, 27563238.84, 33174159.72, 4554292.59, 4134113.56, 4974471.63),
    ("2021-Q1", 35583873.34, 32296635.12, 38871111.56, 5336700.75, 4844336.74, 5829064.76),
    ("2021-Q2", 12264685.49, 11131673.85, 13397697.14, 1839411.36, 1669707.26, 2009115.45),
    ("2021-Q3", 11719735.25, 10637066.11, 12802404.39, 1757726.14, 1595558.33, 1919893.95),
    ("2021-Q4", 35991592.81, 32666689.47, 39316496.15, 5397859.03, 4899852.56, 5895865.51),
]
GROWTH = {"Revenue": 1.185154243, "Profit": 1.185224472}
MAPE = {"Revenue": 0.09238, "Profit": 0.09226}


def fact(spark, rows=QUARTERS):
    data = [(q, int(q[:4]), int(q[-1]), float(r), float(p)) for q, r, p in rows]
    return spark.createDataFrame(data, "Year_Quarter string, Year int, Quarter_Num int, Revenue double, Profit double")


def long(spark, rows=QUARTERS):
    return series.long_series(series.quarterly_series(fact(spark, rows)))


def test_quarter_index_and_sums(spark):
    rows = spark.createDataFrame(
        [("2019-Q1", 2019, 1, 100, 10), ("2019-Q2", 2019, 2, 200, 20), ("2019-Q1", 2019, 1, 50, 5)],
        "Year_Quarter string, Year int, Quarter_Num int, Revenue bigint, Profit bigint")
    got = [tuple(r) for r in series.quarterly_series(rows).orderBy("Quarter_Idx").collect()]
    assert got == [("2019-Q1", 1, 1, 150, 15), ("2019-Q2", 2, 2, 200, 20)]
    indexed = series.add_quarter_index(rows)
    assert sorted(r["Quarter_Idx"] for r in indexed.collect()) == [1, 1, 2]


def test_gap_keeps_dense_index(spark):
    rows = [("2019-Q1", 1, 1), ("2019-Q3", 2, 2)]
    assert [r[0] for r in series.quarter_calendar(fact(spark, rows)).orderBy("Year_Quarter").select("Quarter_Idx").collect()] == [1, 2]


def test_published_forecast_reproduced(spark, monkeypatch):
    monkeypatch.setattr(forecasting, "_growth", lambda frame: F.when(
        F.col("Target") == "Revenue", GROWTH["Revenue"]).otherwise(GROWTH["Profit"]))
    chosen = spark.createDataFrame(
        [(t, "SeasonalGrowth", "", "", MAPE[t]) for t in MAPE],
        "Target string, Model string, Order string, Seasonal_Order string, Backtest_MAPE double")
    rows = forecasting.wide_forecast(forecasting.forecast(long(spark), chosen)).collect()
    for got, want in zip(rows, FORECAST):
        assert got["Quarter"] == want[0]
        values = [got[c] for c in ("Predicted_Revenue", "Revenue_CI_Lower", "Revenue_CI_Upper",
                                   "Predicted_Profit", "Profit_CI_Lower", "Profit_CI_Upper")]
        assert values == pytest.approx(want[1:], abs=0.011)


def test_seasonal_random_walk_matches_published_backtest(spark):
    runs = forecasting.backtest(long(spark), min_train_idx=5).where("Model = 'SeasonalRandomWalk' AND Target = 'Revenue'")
    first = runs.where("Validation_Quarter = '2019-Q1'").first()
    assert (first["Predicted"], first["Error"], first["MAPE"], first["sMAPE"]) == (20278548.0, 2654540.0, 0.1506, 0.1401)


def test_short_history_falls_back_or_reports(spark):
    runs = {(r["Model"], r["Order"]): r for r in
            forecasting.backtest(long(spark, QUARTERS[:3]), min_train_idx=2).where("Target = 'Revenue'").collect()}
    recent = (16257873 + 14915388) / 2
    assert runs[("SeasonalGrowth", "")]["Predicted"] == pytest.approx(recent)
    assert runs[("SeasonalNaive", "")]["Predicted"] == pytest.approx(recent)
    walk = runs[("SeasonalRandomWalk", "(0, 1, 0)")]
    assert walk["MAPE"] is None and not walk["Converged"] and walk["error_message"]
    summary = forecasting.backtest_summary(forecasting.backtest(long(spark, QUARTERS[:3]), min_train_idx=2))
    assert summary.count() == 4


def recursion(model, order, y, periods):
    y = list(y)
    sd = [y[i] - y[i - 4] for i in range(4, len(y))]
    cd = [sd[i] - sd[i - 1] for i in range(1, len(sd))]
    phi = lambda w: sum(a * b for a, b in zip(w[1:], w)) / sum(b * b for b in w[:-1])
    growth = float(np.median([y[i] / y[i - 4] for i in range(4, len(y))]))
    a, b, c = phi(sd), phi(cd), cd[-1]
    start = len(y)
    for _ in range(periods):
        if model == "SeasonalGrowth":
            y.append(max(y[-4] * growth, 0))
        elif model == "SeasonalRandomWalk":
            y.append(y[-1] + y[-4] - y[-5])
        elif order == "(1, 0, 0)":
            y.append(y[-4] + a * (y[-1] - y[-5]))
        else:
            c *= b
            y.append(y[-1] + y[-4] - y[-5] + c)
    return y[start:]


@pytest.mark.parametrize("model,order,seasonal", forecasting.MODELS[1:])
def test_closed_forms_equal_recursion(spark, model, order, seasonal):
    chosen = spark.createDataFrame([("Revenue", model, order, seasonal, 0.1)],
                                   "Target string, Model string, Order string, Seasonal_Order string, Backtest_MAPE double")
    rows = forecasting.forecast(long(spark), chosen, periods=9).orderBy("Quarter_Idx").collect()
    expected = recursion(model, order, [r for _, r, _ in QUARTERS], 9)
    assert [r["Predicted"] for r in rows] == pytest.approx([max(v, 0) for v in expected], rel=1e-9, abs=0.01)


def test_summary_selection_and_null_metrics(spark):
    rows = [("Revenue", "SeasonalGrowth", e, abs(e), m, s) for e, m, s in (
        (852139.81, 0.0484, 0.0472), (535125.32, 0.0613, 0.0595), (365346.0, 0.0438, 0.0428),
        (-76087.9, 0.0030, 0.0030), (-9165678.0, 0.3054, 0.3604))] + [("Revenue", "Flat", 1.0, 1.0, 0.5, 0.5),
                                                                     ("Revenue", "Broken", None, None, None, None)]
    df = spark.createDataFrame(rows, "Target string, Model string, Error double, MAE double, MAPE double, sMAPE double")
    df = df.selectExpr("*", "'' AS Order", "'' AS Seasonal_Order", "Error AS Bias", "cast(null as double) AS AIC",
                       "cast(null as double) AS BIC", "true AS Converged")
    summary = forecasting.backtest_summary(df)
    growth = summary.where("Model = 'SeasonalGrowth'").first()
    assert growth["Backtest_MAPE"] == pytest.approx(0.09238)
    assert growth["Backtest_sMAPE"] == pytest.approx(0.10258)
    assert growth["Median_MAPE"] == pytest.approx(0.0484)
    assert growth["Backtest_RMSE"] == pytest.approx(float(np.sqrt(np.mean([r[2] ** 2 for r in rows[:5]]))))
    assert summary.count() == 2
    assert forecasting.selected_models(summary).first()["Model"] == "SeasonalGrowth"


def test_unit_root_needs_eight_varying_values(spark):
    flat = [(f"20{10 + i // 4}-Q{i % 4 + 1}", 5, i * i % 7) for i in range(12)]
    got = {(r["Target"], r["Transform"]): r for r in series.stationarity_diagnostics(long(spark, flat)).collect()}
    assert got[("Revenue", "level")]["DF_Statistic"] is None
    assert got[("Profit", "diff_1_and_seasonal_diff_4")]["N_Obs"] == 7
    assert got[("Profit", "diff_1_and_seasonal_diff_4")]["DF_Statistic"] is None
    y = np.array([i * i % 7 for i in range(12)], float)
    x, dy = y[:-1], np.diff(y)
    design = np.column_stack([np.ones(len(x)), x])
    beta, res = np.linalg.lstsq(design, dy, rcond=None)[:2]
    se = np.sqrt(res[0] / (len(x) - 2) * np.linalg.inv(design.T @ design)[1, 1])
    assert got[("Profit", "level")]["DF_Statistic"] == pytest.approx(beta[1] / se)


def test_lagged_unit_root_equals_least_squares(spark):
    rng = np.random.default_rng(4)
    y = np.cumsum(rng.normal(size=24)) + 50
    rows = [(f"20{10 + i // 4}-Q{i % 4 + 1}", float(v), 5.0) for i, v in enumerate(y)]
    got = {(r["Target"], r["Transform"], r["Lag"]): r for r in series.lagged_unit_root(long(spark, rows)).collect()}
    dy = np.diff(y)
    aic = []
    for lag in range(3):
        def fit(start):
            design = np.column_stack([np.ones(len(dy) - start), y[start:-1], *[dy[start - i : len(dy) - i] for i in range(1, lag + 1)]])
            beta, res = np.linalg.lstsq(design, dy[start:], rcond=None)[:2]
            return design, beta, res[0]
        design, beta, res = fit(lag)
        se = np.sqrt(res / (len(design) - lag - 2) * np.linalg.inv(design.T @ design)[1, 1])
        row = got[("Revenue", "level", lag)]
        assert (row["DF_Statistic"], row["N_Used"]) == (pytest.approx(beta[1] / se, rel=1e-6), len(design))
        n = len(dy) - 2
        aic.append(n * np.log(fit(2)[2] / n) + 2 * (lag + 2))
        assert row["AIC"] == pytest.approx(aic[-1], rel=1e-6)
    assert [got[("Revenue", "level", k)]["Selected"] for k in range(3)] == [k == int(np.argmin(aic)) for k in range(3)]
    assert all(got[("Profit", "level", k)]["DF_Statistic"] is None and got[("Profit", "level", k)]["AIC"] is None for k in range(3))
    short = series.lagged_unit_root(long(spark, rows[:6])).where("Transform = 'level'").collect()
    assert len(short) == 6 and all(r["DF_Statistic"] is None for r in short)


def test_next_row_fallbacks(spark):
    row = series.next_forecast_row(long(spark, QUARTERS[:2])).where("Target = 'Revenue'").first()
    mean = (16257873 + 14915388) / 2
    assert (row["Year_Quarter"], row["lag1"], row["lag4"], row["lag5"]) == ("2018-Q2", 14915388.0, mean, mean)
    single = series.next_forecast_row(long(spark, [("2019-Q4", 0, 1)])).where("Target = 'Revenue'").first()
    assert (single["Year_Quarter"], single["roll4_std"], single["yoy_growth"]) == ("2020-Q1", 0.0, 1.0)


def brute_css(values, order, seasonal, periods=0):
    """Least squares over the grid with plain loops: the next value, or a path."""
    sd = [b - a for a, b in zip(values, values[4:])]
    w = [b - a for a, b in zip(sd, sd[1:])] if order[1] else sd
    best = None
    for point in seasonal_css.grid_points(order, seasonal):
        a1, a2, s4, m1, m2, n4 = point
        ahead = lambda x, e: (
            a1 * x[-1] + a2 * x[-2] + s4 * x[-4] - a1 * s4 * x[-5] + m1 * e[-1] + m2 * e[-2] + n4 * e[-4] + m1 * n4 * e[-5])
        x, e = [0.0] * 5, [0.0] * 5
        for v in w:
            e.append(v - ahead(x, e))
            x.append(v)
        sse = 0.0
        for v in e:
            sse += v * v
        if best is None or (sse, point) < best[0]:
            path, level, y = [], sd[-1], list(values)
            for _ in range(max(1, periods)):
                v = ahead(x, e)
                x.append(v)
                e.append(0.0)
                level = level + v if order[1] else v
                y.append(y[-4] + level)
                path.append(y[-1])
            best = (sse, point), path
    return best[1]


@pytest.mark.parametrize("order,seasonal", seasonal_css.ORDERS)
def test_css_models_equal_plain_loops(spark, order, seasonal):
    chosen = spark.createDataFrame([("Revenue", seasonal_css.MODEL, str(order), str(seasonal), 0.1)],
                                   "Target string, Model string, Order string, Seasonal_Order string, Backtest_MAPE double")
    rows = forecasting.forecast(long(spark), chosen, periods=9).orderBy("Quarter_Idx").collect()
    values = [float(r) for _, r, _ in QUARTERS]
    assert [r["Predicted"] for r in rows] == pytest.approx([max(v, 0) for v in brute_css(values, order, seasonal, 9)], rel=1e-9, abs=0.01)
    runs = forecasting.one_step_predictions(long(spark)).where(
        (F.col("Target") == "Revenue") & (F.col("Order") == str(order)) & (F.col("Seasonal_Order") == str(seasonal)) & (F.col("Model") == seasonal_css.MODEL))
    got = {r["Quarter_Idx"]: r["Forecast"] for r in runs.collect()}
    first = 6 + order[1]
    assert set(got) == set(range(1, 11)) and all(got[q] is None for q in range(1, first))
    for q in range(first, 11):
        assert got[q] == pytest.approx(max(brute_css(values[: q - 1], order, seasonal)[0], 0), rel=1e-9, abs=0.01)


def test_css_grid_stays_inside_its_bounds():
    for order, seasonal in seasonal_css.ORDERS:
        points = seasonal_css.grid_points(order, seasonal)
        assert (0.0,) * 6 in points and len(set(points)) == len(points) <= 1000
        assert all(abs(c) < 1 for p in points for c in p)
