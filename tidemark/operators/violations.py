"""The quality gate as a violation ledger: one bit mask per fact row.

Every row-level check sets a bit once. The report, the list of bad rows and the blocking verdict are aggregates and filters
of the masks, so the fact is neither joined nor grouped again for another view of the same defects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from .quality import NATURAL_GRAIN, NO_SOURCE_ID, REQUIRED, STALE_SOURCE, Check, duplicate_rows, missing_columns
from .scale import attach_row, null_safe_join, small_table

#: Checks of single rows in bit order, with the expectation each reports.
RULES = (
    ("fact_sales_unique_fact_id", "0 duplicates"),
    ("fact_sales_possible_duplicate_transactions", "0 duplicate natural-grain rows"),
    ("fact_sales_Customer_ID_not_null", "0 nulls"),
    ("fact_sales_Product_ID_not_null", "0 nulls"),
    ("fact_sales_Date_Key_not_null", "0 nulls"),
    ("fact_customer_fk_integrity", "0 orphan rows"),
    ("fact_product_fk_integrity", "0 orphan rows"),
    ("fact_date_fk_integrity", "0 orphan rows"),
    ("fact_geography_fk_integrity", "0 orphan rows"),
    ("fact_sales_no_negative_revenue", "0 rows"),
    ("fact_sales_no_negative_profit", "0 rows"),
    ("fact_sales_accepted_quarter_values", "Q1, Q2, Q3, Q4 only"),
)
BITS = {name: 1 << k for k, (name, _) in enumerate(RULES)}
#: What ``report`` reads of a ledger.
REPORTED = ("violations", "Quarter", "Year", "Is_Full_Year")
WARNINGS = BITS["fact_sales_possible_duplicate_transactions"]
PARENTS = (("customer", "Customer_ID", "DIM_Customer"), ("product", "Product_ID", "DIM_Product"),
           ("date", "Date_Key", "DIM_Date"), ("geography", "Geo_Key", "DIM_Geography"))


def _with_repeats(fact: DataFrame, plain: DataFrame, keys: list[str], out: str) -> DataFrame:
    """Flag rows whose key an earlier row (by ``__row``) has. Only repeated keys are joined back, found in the ``plain`` rows,
    before anything else was joined to them."""
    first = plain.groupBy(*keys).agg(F.min("__row").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    flagged = null_safe_join(fact, first, keys, "left")
    return flagged.withColumn(out, F.coalesce(F.col("__row") > F.col("__first"), F.lit(False))).drop("__first")


def _with_orphans(fact: DataFrame, plain: DataFrame, parent: DataFrame, key: str, out: str) -> DataFrame:
    """Flag rows whose key the parent lacks; null only matches null. A key is looked up once, however many rows have it.

    The lost keys are counted first: where they are few, the rows stay in place.
    """
    known = parent.select(key).distinct().withColumn("__known", F.lit(True))
    lost = null_safe_join(plain.select(key).distinct(), known, [key], "left").where("__known IS NULL").select(key)
    lost = lost.withColumn(out, F.lit(True))
    small = small_table(lost)
    return null_safe_join(fact, lost if small is None else F.broadcast(small), [key], "left").withColumn(out, F.coalesce(out, F.lit(False)))


def ledger(tables: dict[str, DataFrame], stored: str | None = None) -> DataFrame:
    """The fact with ``violations``: the bits of ``RULES`` that a row fails (0 for a clean row).

    Of rows that share an id or a natural grain one stays clean of that bit, whichever was stored first. The tables need the
    columns of ``REQUIRED``, ``Fact_ID`` and ``Geo_Key``; a missing one raises and names it. ``stored`` names a column of
    distinct numbers in stored order, for a fact that is not itself a stored table.

    The bits of single rows and lookups come first, then repeats of the grain, then of the id: a reader of the masks alone
    moves the grain once and then only ids and masks.
    """
    needed = {**REQUIRED, "FACT_Sales": (*REQUIRED["FACT_Sales"], *NATURAL_GRAIN, "Fact_ID"), "DIM_Geography": ("Geo_Key",)}
    for table, columns in needed.items():
        missing = missing_columns(tables[table], columns)
        if missing:
            raise ValueError(f"{table} lacks {', '.join(missing)}")
    columns = [c for c in tables["FACT_Sales"].columns if c != stored]
    fact = tables["FACT_Sales"].withColumn("__row", F.monotonically_increasing_id() if stored is None else F.col(stored))
    plain = fact
    for label, key, table in PARENTS:
        fact = _with_orphans(fact, plain, tables[table], key, f"__orphan_{label}")
    failed = (
        *[F.col(c).isNull() for c in ("Customer_ID", "Product_ID", "Date_Key")],
        *[F.col(f"__orphan_{label}") for label, _, _ in PARENTS],
        F.col("Revenue") < 0, F.col("Profit") < 0, ~F.col("Quarter").isin(*fixed.QUARTERS),
    )
    names = [name for name, _ in RULES]
    fact = fact.select(*columns, "__row", _mask(F.lit(0).cast("bigint"), dict(zip(names[2:], failed))).alias("violations"))
    for name, keys in zip(names[1::-1], (list(NATURAL_GRAIN), ["Fact_ID"])):
        fact = _with_repeats(fact, plain, keys, "__repeated")
        fact = fact.select(*columns, "__row", _mask(F.col("violations"), {name: F.col("__repeated")}).alias("violations"))
    return fact.drop("__row")


def _mask(mask: Column, failed: dict[str, Column]) -> Column:
    for name, fails in failed.items():
        mask = mask.bitwiseOR(F.when(F.coalesce(fails, F.lit(False)), F.lit(BITS[name])).otherwise(F.lit(0)).cast("bigint"))
    return mask


def fails(name: str) -> Column:
    return F.col("violations").bitwiseAND(F.lit(BITS[name])) != 0


def bad_rows(entries: DataFrame) -> DataFrame:
    """Rows that fail a check, with the names of the checks."""
    names = F.array_compact(F.array(*[F.when(fails(n), F.lit(n)) for n, _ in RULES]))
    return entries.where("violations <> 0").withColumn("failed_checks", names)


def blocks(entries: DataFrame) -> bool:
    """Whether any row fails a check that stops the run."""
    return not entries.where(F.col("violations").bitwiseAND(F.lit(~WARNINGS)) != 0).isEmpty()


def mask_counts(entries: DataFrame, ignore: int = 0) -> DataFrame:
    """Rows per combination of failed checks."""
    mask = F.col("violations").bitwiseAND(F.lit(~ignore))
    return entries.groupBy(mask.alias("violations")).agg(F.count("*").alias("row_count"))


def report(entries: DataFrame, tables: dict[str, DataFrame], partial_year: int = 2020, recent_year: int = 2020) -> DataFrame:
    """The rows of ``quality_report`` from one aggregate of the ledger."""
    in_year = F.col("Year") == partial_year
    counts = entries.agg(
        F.count("*").alias("rows"), *[F.count_if(fails(n)).alias(n) for n, _ in RULES],
        F.countDistinct(F.when(fails("fact_sales_accepted_quarter_values"), F.col("Quarter"))).alias("bad_labels"),
        F.count_if(in_year).alias("partial"), F.count_if(in_year & ~F.col("Is_Full_Year")).alias("flagged"),
        F.max("Year").alias("max_year"),
    )
    wide = attach_row(counts, duplicate_rows(tables["DIM_Customer"], ["Customer_ID"]).toDF("dup_customer"))
    checks = []
    for table, required in REQUIRED.items():
        missing = missing_columns(tables[table], required)
        checks.append(Check(f"{table}_required_columns", F.lit(not missing), F.lit(", ".join(missing) or "none"),
                            "no missing required columns"))
    checks.append(Check("fact_sales_row_count", F.col("rows") > 0, F.col("rows"), "> 0"))
    for name, expected in RULES:
        value = F.col(name)
        if name == "fact_sales_accepted_quarter_values":
            value = F.when(F.col("bad_labels") == 0, "none").otherwise(F.col("bad_labels").cast("string"))
        warning = BITS[name] == WARNINGS
        checks.append(Check(name, F.col(name) == 0, value, expected, "WARNING" if warning else "ERROR", NO_SOURCE_ID if warning else ""))
    checks.append(Check("dim_customer_unique_customer_id", F.col("dup_customer") == 0, F.col("dup_customer"), "0 duplicates"))
    whole = (F.col("partial") > 0) & (F.col("partial") == F.col("flagged"))
    checks.append(Check(f"fact_sales_{partial_year}_partial_year_flag", whole,
                        F.when(whole, "present").otherwise("missing_or_invalid"),
                        f"{partial_year} rows exist and Is_Full_Year=false"))
    checks.append(Check("fact_sales_recent_year_warning", F.col("max_year") >= recent_year, F.col("max_year"),
                        f">= {recent_year}", "WARNING", STALE_SOURCE))
    return wide.select(F.inline(F.array(*[c.row() for c in checks])))
