"""Forecast and churn jobs over the curated tables, with their report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import churn, classifiers, forecasting, metrics, scoring, series
from ..session import materialize


def forecast_reports(fact: DataFrame, periods: int = 7) -> dict[str, DataFrame]:
    long = materialize(series.long_series(series.quarterly_series(fact)), "quarterly-series")
    runs = forecasting.backtest(long)
    summary = forecasting.backtest_summary(runs)
    chosen = forecasting.selected_models(summary)
    return {
        "forecast_revenue_profit": forecasting.wide_forecast(forecasting.forecast(long, chosen, periods=periods)),
        "forecast_model_comparison": summary,
        "forecast_backtest": runs,
        "forecast_selected_model_backtest": forecasting.selected_backtest(runs, chosen),
        "time_series_stationarity": series.stationarity_diagnostics(long),
        "time_series_seasonality": series.seasonal_profile(long),
    }


def churn_reports(
    fact: DataFrame, customers: DataFrame, candidates: Sequence[classifiers.Candidate] = classifiers.CANDIDATES
) -> tuple[classifiers.ChurnResult, dict[str, DataFrame]]:
    result = classifiers.train_and_score(
        churn.training_windows(fact, customers),
        materialize(churn.scoring_snapshot(fact, customers), "scoring-snapshot"), candidates
    )
    scored = materialize(scoring.score_customers(result.scored, result.threshold), "scored-customers")
    return result, {
        "churn_model_metrics": result.metrics,
        "churn_confusion_matrix": metrics.confusion_matrix(result.metrics),
        "churn_validation_scores": result.validation,
        "churn_predictions": scored,
        "churn_priority_list": scoring.high_risk(scored),
        "churn_top_customers": scoring.head_of_list(scored),
        "churn_feature_importance": result.importance,
        "churn_model_comparison": result.ranking,
        "churn_backtest": result.folds,
    }
