import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesloom.functions import line_amounts
from salesloom.operators.clean import clean, drop_duplicates, null_profile, transform
from salesloom.operators.quality import quality_report, quality_results

# Known input and output amounts of stored lines:
# price, quantity, discount, revenue, discount amount, gross sales.
KNOWN_AMOUNTS = [
    (2.49, 28, 0.1, 62.75, 6.97, 69.72),
    (4.99, 29, 0.1, 130.24, 14.47, 144.71),
    (79.99, 1, 0.0, 79.99, 0.0, 79.99),
    (19.99, 1, 0.0, 19.99, 0.0, 19.99),
    (29.99, 10, 0.05, 284.9, 15.0, 299.9),
    (24.99, 10, 0.05, 237.4, 12.5, 249.9),
    (4.49, 45, 0.1, 181.85, 20.21, 202.05),
    (2.99, 25, 0.1, 67.28, 7.48, 74.75),
]


def test_known_amounts(spark):
    df = spark.createDataFrame(
        [row[:3] for row in KNOWN_AMOUNTS], "price double, quantity int, discount double"
    )
    amounts = line_amounts(F.col("price"), F.col("quantity"), F.col("discount"))
    got = df.select(*amounts.values()).collect()
    assert [tuple(row) for row in got] == [row[3:] for row in KNOWN_AMOUNTS]


def test_transform_adds_period_and_amounts(spark):
    raw = spark.createDataFrame(
        [("2024-01-10", 100.0, 2, 0.1), ("2024-01-11", 50.0, 3, 0.0)],
        "order_date string, price double, quantity int, discount double",
    )
    rows = transform(raw).orderBy("order_date").collect()
    assert [r.order_year for r in rows] == [2024, 2024]
    assert [r.order_month for r in rows] == [1, 1]
    assert [r.revenue for r in rows] == [180.0, 150.0]
    assert [r.discount_amount for r in rows] == [20.0, 0.0]
    assert [r.gross_sales for r in rows] == [200.0, 150.0]
    assert rows[0].order_date == dt.date(2024, 1, 10)


def test_steps_without_their_columns_do_nothing(spark):
    df = spark.createDataFrame([(1,)], "other int")
    assert transform(clean(df)).columns == ["other"]
    assert null_profile(df).columns == ["remaining_nulls"]


def test_clean_fills_and_clips(spark):
    df = spark.createDataFrame(
        [
            (None, None, None),
            (float("nan"), 1, -0.2),
            (5.0, 2, 1.7),
            (5.0, 3, float("nan")),
        ],
        "price double, quantity int, discount double",
    )
    assert sorted(map(tuple, clean(df).collect())) == [
        (0.0, 0, 0.0),
        (0.0, 1, 0.0),
        (5.0, 2, 1.0),
        (5.0, 3, 0.0),
    ]
    profile = null_profile(df.withColumn("region", F.lit(None).cast("string"))).first()
    assert tuple(profile) == (2, 1, 2, 4)


def test_unreadable_date_is_null_and_reported(spark):
    df = transform(spark.createDataFrame([("not-a-date",), ("2024-03-01",)], "order_date string"))
    rows = df.orderBy(F.asc_nulls_first("order_date")).collect()
    assert tuple(rows[0]) == (None, None, None)
    assert tuple(rows[1]) == (dt.date(2024, 3, 1), 2024, 3)
    assert quality_results(quality_report(df))["order_date_not_null"] is False


def test_drop_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert drop_duplicates(df).count() == 2
    assert drop_duplicates(df, ["k"]).count() == 1


QUALITY_SCHEMA = (
    "order_id string, customer_id string, price double, order_date timestamp, "
    "discount double, quantity int, order_year int"
)


def test_quality_one_bad_discount_fails_overall(spark):
    df = spark.createDataFrame(
        [
            ("o1", "c1", 10.0, dt.datetime(2024, 1, 1), 0.2, 1, 2024),
            ("o2", "c2", 20.0, dt.datetime(2024, 1, 2), 0.9, 2, 2024),
        ],
        QUALITY_SCHEMA,
    )
    results = quality_results(quality_report(df))
    failed = {name for name, passed in results.items() if not passed}
    assert failed == {"discount_in_range", "overall_success"}
    assert len(results) == 9


def test_quality_filled_price_is_present_but_not_positive(spark):
    df = clean(spark.createDataFrame([(None, 1)], "price double, quantity int"))
    results = quality_results(quality_report(df))
    assert results == {
        "price_not_null": True,
        "sales_positive": False,
        "quantity_in_range": True,
        "overall_success": False,
    }


def test_quality_empty_input(spark):
    results = quality_results(quality_report(spark.createDataFrame([], QUALITY_SCHEMA)))
    assert results.pop("order_year_valid_range") is False
    assert results.pop("overall_success") is False
    assert all(results.values())


def test_quality_ignores_missing_values_in_ranges(spark):
    df = spark.createDataFrame(
        [(None, None), (float("nan"), 1)], "discount double, quantity int"
    )
    assert all(quality_results(quality_report(df)).values())


def test_quality_is_one_aggregation(spark):
    df = spark.createDataFrame([], QUALITY_SCHEMA)
    plan = quality_report(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


@pytest.mark.parametrize("columns", [["price"], ["price", "quantity"]])
def test_amounts_need_all_three_columns(spark, columns):
    df = spark.createDataFrame([(1.0, 1)], "price double, quantity int").select(*columns)
    assert transform(df).columns == columns
