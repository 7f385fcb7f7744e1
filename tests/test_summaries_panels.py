import pytest
from pyspark.sql import functions as F

from salesloom.functions import currency, short_number, thousands, year_month
from salesloom.operators import panels
from salesloom.operators.summaries import build_summaries

SCHEMA = (
    "order_year int, customer_id string, region string, category string, "
    "product_name string, revenue double"
)
ROWS = [
    (2024, "c1", "East", "Tech", "P1", 100.0),
    (2024, "c2", "East", "Tech", "P2", 200.0),
    (2025, "c1", "West", "Office", "P3", 150.0),
]


def tuples(df):
    return [tuple(row) for row in df.collect()]


def test_summaries(spark):
    tables = build_summaries(spark.createDataFrame(ROWS, SCHEMA))
    assert set(tables) == {"yearly", "regional_revenue", "top_products"}
    assert tuples(tables["yearly"]) == [(2024, 2, 300.0, 2), (2025, 1, 150.0, 1)]
    assert tuples(tables["regional_revenue"]) == [("East", 300.0, 2, 2), ("West", 150.0, 1, 1)]
    assert tuples(tables["top_products"]) == [
        ("Office", "P3", 150.0),
        ("Tech", "P2", 200.0),
        ("Tech", "P1", 100.0),
    ]


def test_summaries_depend_on_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert build_summaries(df.drop("revenue")) == {}
    assert set(build_summaries(df.drop("region"))) == {"yearly", "top_products"}


def test_null_keys_and_null_customers(spark):
    rows = [
        (2024, "a", None, "T", "P", 1.0),
        (2024, None, "East", "T", "P", 2.0),
        (2024, "a", "East", "T", "P", 3.0),
        (None, "b", "East", None, "P", 4.0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    tables = build_summaries(df)
    assert tuples(tables["yearly"]) == [(2024, 3, 6.0, 1)]
    assert tuples(tables["regional_revenue"]) == [("East", 9.0, 3, 2)]
    assert tuples(tables["top_products"]) == [("T", "P", 6.0)]
    # Panels keep the null group.
    assert tuples(panels.revenue_by_region(df)) == [("East", 9.0), (None, 1.0)]


def test_ties_in_top_products_go_by_name(spark):
    rows = [(2024, "c", "R", "T", name, 5.0) for name in "DBAC"]
    top = build_summaries(spark.createDataFrame(rows, SCHEMA))["top_products"]
    assert [r.product_name for r in top.collect()] == ["A", "B", "C"]


def test_money_is_exact_for_any_partitioning(spark):
    amounts = spark.range(100_000).select(
        F.lit("East").alias("region"), F.lit(0.1).alias("revenue"), F.lit("c").alias("customer_id")
    )
    for parts in (1, 7, 64):
        total = panels.revenue_by_region(amounts.repartition(parts)).first().total_revenue
        assert total == 10000.0


def test_negative_and_missing_money(spark):
    df = spark.createDataFrame(
        [("x", -12.34), ("x", 0.01), ("x", None), ("x", float("nan")), ("y", None)],
        "region string, revenue double",
    )
    assert tuples(panels.revenue_by_region(df)) == [("y", 0.0), ("x", -12.33)]


PANEL_SCHEMA = (
    "order_year int, order_month int, revenue double, quantity int, order_id string, "
    "customer_id string, customer_name string, product_id string, product_name string, "
    "segment string, category string, city string, region string"
)


def panel_line(year=2024, month=1, revenue=10.0, order_id="o1", customer="a", name="Ann"):
    return (
        year, month, revenue, 2, order_id, customer, name, "p1", "Pen", "Consumer", "Office",
        "Boston", "East",
    )


def test_kpis_count_null_as_a_value(spark):
    lines = [panel_line(customer=c) for c in ("a", None, "a")]
    row = panels.kpis(spark.createDataFrame(lines, PANEL_SCHEMA)).first()
    assert tuple(row) == (30.0, 3, 6, 2, 1)


def test_empty_selection(spark):
    df = spark.createDataFrame([panel_line()], PANEL_SCHEMA)
    result = panels.panels(panels.filter_period(df, years=[], months=[1]))
    assert tuple(result["kpis"].first()) == (0.0, 0, 0, 0, 0)
    assert all(p.isEmpty() for name, p in result.items() if name != "kpis")
    text = panels.kpis_text(panels.filter_period(df, years=[])).first()
    assert tuple(text) == ("$0", "0", "0", "0", "0", None, None)


def test_selection_drops_unknown_periods(spark):
    lines = [panel_line(), panel_line(year=None), panel_line(month=None), panel_line(month=3)]
    df = spark.createDataFrame(lines, PANEL_SCHEMA)
    assert panels.filter_period(df).count() == 2
    assert panels.filter_period(df, [2024], [3]).count() == 1


def test_orders_by_month_counts_lines_with_an_order(spark):
    lines = [panel_line(), panel_line(), panel_line(order_id=None), panel_line(month=11)]
    df = spark.createDataFrame(lines, PANEL_SCHEMA)
    assert tuples(panels.orders_by_month(df)) == [
        (2024, 1, 2, "2024-01"),
        (2024, 11, 1, "2024-11"),
    ]
    assert tuples(panels.cities(df)) == [("Boston", 40.0, 2, 8)]


def test_customers_who_share_a_name_are_one(spark):
    lines = [panel_line(customer="a"), panel_line(customer="b"), panel_line(name="Bo")]
    df = spark.createDataFrame(lines, PANEL_SCHEMA)
    assert tuples(panels.top_customers(df)) == [("Ann", 20.0), ("Bo", 10.0)]
    shown = panels.display_table(panels.top_customers(df, 1))
    assert shown.columns == ["Customer", "Revenue"]
    assert tuples(shown) == [("Ann", "$20")]


def test_orders_are_counted_for_shown_products_only(spark):
    """The lines that are grouped by order are joined with the products shown beforehand."""
    schema = "category string, product_name string, order_id string, revenue double, quantity int"
    lines = [("Office", f"P{i % 40}", f"o{i}", float(i % 40), 1) for i in range(400)]
    lines += [("Office", "P39", order, 0.0, 2) for order in ("o39", "o39", None)]
    lines += [(None, None, order, 500.0, 1) for order in ("a", "a", None)]
    lines += [(None, "P39", "a", 390.0, None), ("Office", None, "a", 390.0, 1)]
    top = panels.top_products(spark.createDataFrame(lines, schema), 4)
    by_order = [
        line for line in top._jdf.queryExecution().optimizedPlan().toString().split("\n")
        if "LeftSemi" in line or "count(distinct order_id" in line
    ]
    assert len(by_order) == 2 and "LeftSemi" in by_order[1]
    assert tuples(top) == [
        (None, None, 1500.0, 2, 3),
        (None, "P39", 390.0, 1, 0),
        ("Office", None, 390.0, 1, 1),
        ("Office", "P39", 390.0, 11, 16),
    ]


@pytest.mark.parametrize(
    "value, text",
    [
        (0, "0"),
        (999, "999"),
        (1000, "1.0K"),
        (1250, "1.2K"),
        (999_950, "1000.0K"),
        (1e6, "1.0M"),
        (1e9, "1.0B"),
        (-5000, "-5000"),
    ],
)
def test_short_number(spark, value, text):
    df = spark.createDataFrame([(float(value),)], "x double")
    assert df.select(short_number(F.col("x"))).first()[0] == text


def test_texts_match_python_formats(spark):
    values = [i / 8 for i in range(-4000, 4000, 7)] + [0.5, 1.5, 2.5, 1234567.5, 1e9 + 0.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", thousands(F.col("x")).alias("t"), currency(F.col("x")).alias("c"))
    for x, t, c in rows.collect():
        want = f"{x:,.0f}"
        assert t == want
        assert c == f"${want}"


def test_year_month(spark):
    df = spark.createDataFrame([(2024, 3), (2024, 12), (None, 1)], "y int, m int")
    assert [r[0] for r in df.select(year_month(F.col("y"), F.col("m"))).collect()] == [
        "2024-03",
        "2024-12",
        None,
    ]


def test_cube_gives_the_same_panels(spark):
    lines = [
        panel_line(revenue=0.1 * i, month=1 + i % 5, order_id=None if i % 7 == 0 else f"o{i % 11}")
        for i in range(60)
    ] + [panel_line(revenue=None, month=9)]
    df = spark.createDataFrame(lines, PANEL_SCHEMA).withColumn("revenue", F.round("revenue", 2))
    cube = panels.monthly_cube(df)
    for name, panel in panels.CUBE_PANELS.items():
        assert tuples(panel(cube)) == tuples(panel(df)), name
        assert panel(cube).schema == panel(df).schema or name == "orders_by_month"
