import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.operators import star
from salesloom.operators.clean import with_amounts
from salesloom.operators.keys import key_report, with_surrogate_key
from salesloom.schemas import SALES
from salesloom.sinks import files, warehouse
from salesloom.sources import tpch


def line(row_id, **changes):
    row = dict(
        row_id=row_id,
        order_id=f"US-2024-{100000 + row_id}",
        order_date=dt.date(2024, 2, 28),
        ship_date=dt.date(2024, 3, 1),
        ship_mode="First Class",
        customer_id="AL-10000",
        customer_name="Ann Lee",
        segment="Consumer",
        city="Boston",
        state="Massachusetts",
        postal_code="02115",
        region="East",
        category="Furniture",
        sub_category="Desks",
        product_id="FUR-DE-1",
        product_name="Desk",
        price=80.0,
        quantity=2,
        discount=0.0,
        order_year=2024,
        order_month=2,
        revenue=160.0,
        discount_amount=0.0,
        gross_sales=160.0,
    )
    row.update(changes)
    return tuple(row[f] for f in SALES.fieldNames())


def sales(spark, *lines):
    return spark.createDataFrame(list(lines), SALES)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_surrogate_key_equals_global_row_number(spark, partitions):
    rng = random.Random(partitions)
    some = lambda values: rng.choice([None, *values])
    rows = {(some("abc"), some(range(5)), rng.randrange(10**6)) for _ in range(3000)}
    df = spark.createDataFrame(list(rows), "a string, b int, c int").repartition(partitions)
    order = [F.asc_nulls_last(c) for c in "abc"]
    got = with_surrogate_key(df, order, "key").select("a", "b", "c", "key")
    want = df.withColumn("key", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert got.exceptAll(want).isEmpty()
    assert got.count() == want.count()


def test_surrogate_key_spreads_a_large_group_of_copies(spark):
    """Copies get numbers of their own, and no range partition holds all of them."""
    df = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("_line"),
    )
    # Without coalescing, so that the layout of the written table can be seen.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.asc_nulls_last("k"), F.asc("_line")]
        numbered = with_surrogate_key(df, order, "key", drop=["_line"])
        bounds = numbered.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first()
        hot_files = (
            numbered.where("k = 'hot'").select(F.input_file_name()).distinct().count()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tuple(bounds) == (1, 40_000, 40_000)
    assert hot_files > 1
    assert numbered.columns == ["key", "k"]


def test_surrogate_key_of_nothing(spark):
    df = spark.createDataFrame([], "a string")
    assert with_surrogate_key(df, [F.asc("a")], "key").count() == 0


def test_surrogate_key_plan_has_no_single_partition_step(spark):
    df = spark.range(1000).withColumn("k", F.hash("id"))
    plan = with_surrogate_key(df, [F.asc("k"), F.asc("id")], "key")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in text and "Window" not in text and "Join" not in text


def test_key_report(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None)], "k string, n int"
    )
    rows = {
        r.key_columns: tuple(r)[2:]
        for r in key_report([("t", df, ["k"]), ("t", df, ["k", "n"])]).collect()
    }
    assert rows == {"k": (2, 5, 0), "k, n": (1, 2, 2)}


@pytest.mark.parametrize("most_runs", [100_000, 0])
def test_numbered_keys_are_told_by_their_runs(spark, most_runs):
    """Runs that lie apart prove a key; everything else is counted, with the same figures."""
    dense = spark.range(1000).select((F.col("id") + 1).alias("k"))
    gaps = spark.range(50).select((F.col("id") * 3).cast("int").alias("k"))
    mixed = dense.orderBy(F.rand(1))
    twice = dense.union(spark.range(5).select(F.col("id") + 1))
    holes = dense.select(F.when(F.col("k") > 4, F.col("k")).alias("k"))
    far = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (None,)], "k bigint")
    tables = {"dense": dense, "gaps": gaps, "mixed": mixed, "twice": twice, "holes": holes, "far": far, "none": dense.limit(0)}
    report = key_report([(name, df, ["k"]) for name, df in tables.items()], most_runs)
    assert {r.table_name: tuple(r)[2:] for r in report.collect()} == {
        "dense": (0, 0, 0),
        "gaps": (0, 0, 0),
        "mixed": (0, 0, 0),
        "twice": (5, 10, 0),
        "holes": (0, 0, 4),
        "far": (0, 0, 1),
        "none": (0, 0, 0),
    }


def test_stored_row_ids_are_not_shuffled_to_be_checked(spark):
    stored = tpch.numbered_sales(spark, "/root/testdata/sf0.001")
    text = key_report([("sales", stored, ["row_id"])])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "HashAggregate" not in text


def test_lines_are_read_once_for_numbered_sales(spark):
    """One join of the lines, whose result is what gets sorted, numbered and stored."""
    lines = tpch.read(spark, "/root/testdata/sf0.001", "lineitem").withColumn("_line", F.lit(1))
    text = tpch._joined(spark, "/root/testdata/sf0.001", lines)._jdf.queryExecution().executedPlan().toString()
    assert text.count("lineitem.parquet") == 1
    stored = tpch.numbered_sales(spark, "/root/testdata/sf0.001")
    text = stored._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "Exchange" not in text


def test_star_of_two_days(spark):
    built = star.build_star(
        sales(
            spark,
            line(1),
            line(
                2,
                order_date=dt.date(2024, 3, 1),
                ship_date=dt.date(2024, 3, 5),
                customer_id="BO-10001",
                customer_name="Bo",
                region=None,
                city="Austin",
                postal_code=None,
            ),
        )
    )
    assert [tuple(r) for r in built.dim_date.orderBy("date_key").collect()] == [
        (20240228, dt.date(2024, 2, 28), 2024, 2, "February"),
        (20240229, dt.date(2024, 2, 29), 2024, 2, "February"),
        (20240301, dt.date(2024, 3, 1), 2024, 3, "March"),
    ]
    # A null region sorts last.
    assert {r.city: r.location_key for r in built.dim_location.collect()} == {
        "Boston": 1,
        "Austin": 2,
    }
    fact = {r.sales_key: r for r in built.fact_sales.collect()}
    assert (fact[1].customer_key, fact[2].customer_key) == (1, 2)
    # A null in the join key matches nothing.
    assert (fact[1].location_key, fact[2].location_key) == (1, None)
    assert (fact[1].ship_date_key, fact[1].ship_latency_days) == (20240301, 2)
    assert tuple(star.foreign_key_coverage(built.fact_sales).first()) == (2, 2, 2, 1, 2)
    assert tuple(star.row_counts(built).first()) == (2, 2, 1, 2, 3, 2)
    gap = star.ship_date_gap(built.fact_sales, built.dim_date).collect()
    assert [tuple(r) for r in gap] == [(20240305, 1)]


def test_ship_date_after_the_last_order_year(spark):
    lines = sales(spark, line(1, order_date=dt.date(2024, 12, 31), ship_date=dt.date(2025, 1, 3)))
    fact = star.with_date_keys(lines)
    row = fact.first()
    assert (row.ship_date_key, row.ship_latency_days) == (20250103, 3)
    assert star.ship_date_gap(fact, star.dim_date(lines)).count() == 1


def test_no_dates_no_calendar(spark):
    assert star.dim_date(sales(spark, line(1, order_date=None))).count() == 0
    assert star.dim_date(sales(spark)).count() == 0


def problems(built):
    return {
        (r.table_name, r.key_columns)
        for r in star.key_problems(built).collect()
        if r.duplicate_keys > 0
    }


def test_key_problems(spark):
    two_names = sales(spark, line(1), line(2, customer_name="Ann B. Lee"))
    assert problems(star.build_star(two_names)) == {("dim_customer", "customer_id")}
    two_regions = sales(spark, line(1), line(2, region="West"))
    assert problems(star.build_star(two_regions)) == {("dim_location", "city, state, postal_code")}
    new_price = sales(spark, line(1), line(2, price=81.0))
    assert problems(star.build_star(new_price)) == {("dim_product", "product_id")}
    same_row = sales(spark, line(1), line(1))
    assert problems(star.build_star(same_row)) == {("sales", "row_id")}
    assert problems(star.build_star(sales(spark, line(1), line(2)))) == set()


def test_revenue_by_month_adds_up(spark):
    lines = sales(spark, line(1), line(2, order_date=dt.date(2024, 3, 2), revenue=0.1))
    fact = star.fact_sales(lines, *star.dimensions(lines))
    got = star.revenue_by_month(fact, star.dim_date(lines)).collect()
    assert [tuple(r) for r in got] == [(2024, 2, "February", 160.0), (2024, 3, "March", 0.1)]


def test_long_source_keys_stay_whole(spark):
    row = spark.range(1).selectExpr(
        f"{tpch._nine_digits('42')} AS short", f"{tpch._nine_digits('12345678901')} AS long"
    )
    assert tuple(row.first()) == ("000000042", "12345678901")


def test_fact_lines_are_not_joined_by_broadcasting_lines(spark):
    """Orders and lines meet in a merge join at any size."""
    plan = tpch.sales(spark, "/root/testdata/sf0.001")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [l_orderkey" in text


def test_period_reaches_the_orders_scan(spark):
    from salesloom.operators.panels import filter_period, period_bounds

    period = {"years": [1997, 1996], "months": [2, 12]}
    assert period_bounds(**period) == (dt.date(1996, 2, 1), dt.date(1998, 1, 1))
    assert period_bounds([1996], [3]) == (dt.date(1996, 3, 1), dt.date(1996, 4, 1))
    assert period_bounds(months=[3]) is None and period_bounds([], [3]) is None and period_bounds([1996], []) is None
    base = "/root/testdata/sf0.001"
    lines = tpch.sales(spark, base, period_bounds(**period))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = lines._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(o_orderdate,1996-02-01T00:00)" in text
    assert "LessThan(o_orderdate,1998-01-01T00:00)" in text

    from salesloom.operators.clean import transform

    with_bounds = filter_period(transform(lines), **period)
    without = filter_period(transform(tpch.sales(spark, base)), **period)
    assert with_bounds.count() > 0 and with_bounds.exceptAll(without).isEmpty()
    assert with_bounds.count() == without.count()


def test_only_needed_columns_are_read(spark):
    from salesloom.operators.clean import clean, transform
    from salesloom.operators.panels import revenue_by_month

    lines = transform(clean(tpch.sales(spark, "/root/testdata/sf0.001")))
    text = revenue_by_month(lines)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_discount:double>" in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_lines_meet_dimensions_in_two_joins(spark):
    """Customers and places are matched before the lines; nulls match nothing, repeated keys multiply."""
    lines = spark.createDataFrame(
        [(1, "a", "p", "X", "S", "1"), (2, None, "p", "X", "S", "1"), (3, "a", None, "X", "S", None), (4, "b", "q", "Y", "S", "2")],
        "row_id bigint, customer_id string, product_id string, city string, state string, postal_code string",
    )
    customers = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "customer_id string, customer_key bigint")
    products = spark.createDataFrame([("p", 1), ("q", 2)], "product_id string, product_key bigint")
    places = spark.createDataFrame(
        [("X", "S", "1", 1), ("X", "S", None, 2), ("Y", "S", "2", 3), ("Y", "S", "2", 4)],
        "city string, state string, postal_code string, location_key bigint",
    )
    keyed = star.with_dimension_keys(lines, customers, products, places)
    rows = keyed.select("row_id", "customer_key", "product_key", "location_key").collect()
    assert sorted(map(tuple, rows), key=repr) == [
        (1, 1, 1, 1), (1, 2, 1, 1), (2, None, 1, 1), (3, 1, None, None), (3, 2, None, None), (4, 3, 2, 3), (4, 3, 2, 4)
    ]
    assert str(keyed._jdf.queryExecution().analyzed()).count("Join ") == 2


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in folders for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def left_behind(spark, before):
    """Shuffle files since ``before``; they are deleted by a message, which takes a moment."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_numbering_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    numbered = tpch.numbered_sales(spark, "/root/testdata/sf0.001")
    assert not left_behind(spark, before)
    assert numbered.count() > 0


def test_silver_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    lines = spark.range(1000).selectExpr("id AS row_id", "1996 AS order_year", "int(id % 12) + 1 AS order_month")
    files.write_silver(lines, str(tmp_path / "silver"))
    assert not left_behind(spark, before)


def test_freeing_blocks_overlap_and_end(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(key, None) is None
    first, second = scratch.freeing(spark), scratch.freeing(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(key, None) is None
    with pytest.raises(ValueError), scratch.freeing(spark):
        raise ValueError
    assert spark.conf.get(key, None) is None


def test_lines_of_an_order_stay_together_until_the_next_shuffle(spark):
    """Parts are joined before orders, unless a period leaves few orders."""
    base = "/root/testdata/sf0.001"
    whole = tpch.sales(spark, base)._jdf.queryExecution().optimizedPlan().toString()
    some = tpch.sales(spark, base, (dt.date(1996, 1, 1), dt.date(1997, 1, 1)))._jdf.queryExecution().optimizedPlan().toString()
    assert whole.index("(l_orderkey") < whole.index("(l_partkey")
    assert some.index("(l_partkey") < some.index("(l_orderkey")


def test_amounts_are_made_behind_the_joins(spark):
    """With ``finish`` no shuffle carries amounts, and the rows are those of lines that have them."""
    lines = sales(spark, line(1, price=9.99, quantity=7, discount=0.15), line(2, quantity=3), line(3, customer_id=None))
    bare = lines.drop("revenue", "discount_amount", "gross_sales")
    with_them, late = star.build_star(with_amounts(bare)), star.build_star(bare, with_amounts)
    want = sorted(map(tuple, with_them.fact_sales.collect()), key=repr)
    assert late.fact_sales.columns == with_them.fact_sales.columns
    assert sorted(map(tuple, late.fact_sales.collect()), key=repr) == want
    assert late.sales.columns[-3:] == ["revenue", "discount_amount", "gross_sales"]

    def early(built):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = warehouse.by_month(built.fact_sales, built.finish)._jdf.queryExecution().executedPlan().toString()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        return "rint(" in text.lower()[text.index("Exchange") :]

    assert early(with_them) and not early(late)
    stored = warehouse.by_month(late.fact_sales, late.finish)
    assert stored.columns == with_them.fact_sales.columns
    assert sorted(map(tuple, stored.collect()), key=repr) == want
