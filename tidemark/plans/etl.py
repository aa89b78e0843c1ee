"""Batch ETL: raw sales to star schema and aggregate tables."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import aggregates, sales, star
from ..session import materialize, tuned
from ..sources import curated


@dataclass
class Star:
    fact_sales: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    dim_geography: DataFrame
    enriched: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in curated.LAYOUT}

    def gate_tables(self) -> dict[str, DataFrame]:
        return {
            "FACT_Sales": self.fact_sales, "DIM_Customer": self.dim_customer, "DIM_Product": self.dim_product,
            "DIM_Date": self.dim_date, "DIM_Geography": self.dim_geography,
        }


def build_star(raw: DataFrame, partial_years: Collection[int] = sales.PARTIAL_YEARS) -> Star:
    """Clean and enrich once, keep the result as a table, derive all star tables from it.

    Fact rows are numbered in stored order, which needs no global sort.
    """
    tuned(raw.sparkSession)
    enriched = materialize(sales.enrich_sales(sales.clean_sales(raw, partial_years)), "enriched")
    product = star.build_dim_product(enriched)
    return Star(
        star.build_fact(enriched, product, id_order=None), star.build_dim_customer(enriched), product,
        star.build_dim_date(enriched), star.build_dim_geography(enriched), enriched,
    )


def publish(built: Star, base: str) -> dict[str, str]:
    return {name: curated.save_curated(df, base, name) for name, df in built.tables().items()}


def aggregate_tables(built: Star) -> dict[str, DataFrame]:
    return aggregates.build_aggregates(built.enriched)
