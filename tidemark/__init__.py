"""Retail analytics on Spark: star schema, marts, quality gate, forecasting, churn."""
