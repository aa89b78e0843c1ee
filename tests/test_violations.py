"""The violation ledger on planted defects."""

import pytest

from tidemark.operators import quality, violations

FACT = ("Fact_ID bigint, Customer_ID string, Product_ID int, Date_Key string, Geo_Key string, Revenue double, Profit double, "
        "Quantity_Sold double, Unit_Sale_Price double, Quarter string, Year int, Is_Full_Year boolean")
CLEAN = (1, "a", 1, "202001", "g", 10.0, 1.0, 2.0, 5.0, "Q1", 2020, False)


def tables(spark, rows):
    return {
        "FACT_Sales": spark.createDataFrame(rows, FACT),
        "DIM_Customer": spark.createDataFrame([("a",), ("b",), ("b",)], "Customer_ID string"),
        "DIM_Product": spark.createDataFrame([(1,)], "Product_ID int"),
        "DIM_Date": spark.createDataFrame([("202001", 2020, "Q1")], "Date_Key string, Year int, Quarter string"),
        "DIM_Geography": spark.createDataFrame([("g",), (None,)], "Geo_Key string"),
    }


def changed(**values):
    names = [c.split()[0] for c in FACT.split(", ")]
    return tuple({**dict(zip(names, CLEAN)), **values}[n] for n in names)


ROWS = [
    CLEAN, changed(Fact_ID=2, Revenue=11.0), changed(Fact_ID=2, Revenue=12.0), changed(Fact_ID=3), changed(Fact_ID=4, Customer_ID=None),
    changed(Fact_ID=5, Customer_ID="x", Revenue=-1.0, Profit=-2.0), changed(Fact_ID=6, Product_ID=9, Quarter="Q7", Geo_Key=None),
    changed(Fact_ID=7, Date_Key="209901", Geo_Key="nowhere", Profit=None, Quarter=None),
]


def test_bits_list_and_verdict(spark):
    entries = violations.ledger(tables(spark, ROWS)).cache()
    got = {}
    for r in violations.bad_rows(entries).collect():
        got.setdefault(r["Fact_ID"], []).append(set(r["failed_checks"]))
    assert got == {
        2: [{"fact_sales_unique_fact_id"}],
        **({3: [{"fact_sales_possible_duplicate_transactions"}]} if 3 in got else {1: [{"fact_sales_possible_duplicate_transactions"}]}),
        4: [{"fact_sales_Customer_ID_not_null", "fact_customer_fk_integrity"}],
        5: [{"fact_customer_fk_integrity", "fact_sales_no_negative_revenue", "fact_sales_no_negative_profit"}],
        6: [{"fact_product_fk_integrity", "fact_sales_accepted_quarter_values"}],
        7: [{"fact_date_fk_integrity", "fact_geography_fk_integrity"}],
    }
    assert violations.blocks(entries) and sum(r["row_count"] for r in violations.mask_counts(entries).collect()) == len(ROWS)
    # A warning alone does not block, and neither does a clean table.
    assert not violations.blocks(violations.ledger(tables(spark, [CLEAN, changed(Fact_ID=8)])))
    assert not violations.blocks(violations.ledger(tables(spark, [])))


@pytest.mark.parametrize("rows", [ROWS, [CLEAN], []])
def test_report_equals_the_gate(spark, rows):
    given = tables(spark, rows)
    order = lambda df: sorted(map(tuple, df.collect()))
    got = violations.report(violations.ledger(given), given)
    want = quality.quality_report(given)
    assert got.columns == want.columns and order(got) == order(want)
    assert quality.has_blocking_failures(got)


def test_missing_columns_are_named(spark):
    given = tables(spark, [CLEAN])
    given["DIM_Date"] = given["DIM_Date"].drop("Year")
    with pytest.raises(ValueError, match="DIM_Date lacks Year"):
        violations.ledger(given)


def test_repeats_follow_a_stored_number(spark):
    rows = [(*changed(Fact_ID=1, Revenue=5.0), 2), (*changed(Fact_ID=1, Revenue=6.0), 1), (*changed(Fact_ID=2, Revenue=6.0), 0)]
    found = tables(spark, ROWS)
    found["FACT_Sales"] = spark.createDataFrame(rows, FACT + ", at bigint")
    entries = violations.ledger(found, "at")
    assert "at" not in entries.columns
    marks = {(r["Fact_ID"], r["Revenue"]): r["violations"] for r in entries.collect()}
    assert marks[1, 5.0] == violations.BITS["fact_sales_unique_fact_id"]
    assert marks[1, 6.0] == violations.WARNINGS and marks[2, 6.0] == 0
