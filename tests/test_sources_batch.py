import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from salesloom import scratch, versions
from salesloom.functions import customer_id, money_sum, round2, to_day
from salesloom.operators import cubes, panels
from salesloom.operators.clean import transform, unread_lines, with_amounts
from salesloom.operators.quality import quality_report
from salesloom.plans.batch import attach, read_reports, run_batch, validate
from salesloom.plans.dashboard import cube_folder, open_dashboard
from salesloom.schemas import SALES, STAR, SUMMARIES
from salesloom.sinks import files, warehouse
from salesloom.sources.catalog import flatten_catalog, nest_catalog, read_catalog
from salesloom.sources.files import read_sales, read_summary
from salesloom.sources.synthetic import (
    CITIES,
    SEGMENTS,
    SHIP_MODES,
    customer_pool,
    discount_tier,
    ship_mode,
    synthetic_sales,
)

CATALOG = {
    "Furniture": {
        "Desks": [{"name": "Small Desk", "price": 79.99, "product_id": "FUR-DE-1"}],
        "Chairs": [
            {"name": "Task Chair", "price": 49.99, "product_id": "FUR-CH-1"},
            {"name": "Stool", "price": 19.99, "product_id": "FUR-CH-2"},
        ],
    },
    "Technology": {"Phones": [{"name": "Desk Phone", "price": 35.5, "product_id": "TEC-PH-1"}]},
    "Office Supplies": {"Paper": [{"name": "Copy Paper", "price": 5.99, "product_id": "OFF-PA-1"}]},
}
START, END = dt.date(2024, 1, 1), dt.date(2024, 3, 31)


@pytest.fixture(scope="module")
def catalog_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("input") / "product_catalog.json"
    path.write_text(json.dumps(CATALOG, indent=2))
    return str(path)


@pytest.fixture(scope="module")
def lines(spark, catalog_path):
    catalog = read_catalog(spark, catalog_path)
    return synthetic_sales(spark, 6000, catalog, START, END, num_customers=50).persist()


def test_catalog(spark, catalog_path):
    rows = read_catalog(spark, catalog_path).collect()
    assert len(rows) == 5
    assert ("Furniture", "Chairs", "Stool", 19.99, "FUR-CH-2") in [tuple(r) for r in rows]


@pytest.mark.parametrize("name, start", [("Ann Lee", "AL-"), ("Cher", "CX-"), ("", "XX-")])
def test_customer_id(spark, name, start):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(customer_id(F.col("name"), F.lit(12345))).first()[0] == f"{start}12345"


def test_documents_nest_and_flatten_again(spark, tmp_path):
    rows = [(f"c{i % 3}", f"s{i % 5}", f"n{i}", i / 4, f"id{i}") for i in range(40)] + [("c0", "s0", "n0", 0.0, "id0")]
    products = spark.createDataFrame(rows, "category string, sub_category string, product_name string, price double, product_id string")
    documents = nest_catalog(products, F.length("product_id"))
    assert documents.count() == 2
    path = str(tmp_path / "lines")
    documents.write.text(path)
    for found in (flatten_catalog(documents), read_catalog(spark, path, lines=True)):
        assert sorted(map(tuple, found.collect())) == sorted(rows)


def test_unread_days_are_kept(spark):
    rows = [(1, "2024-01-02"), (2, "soon"), (3, None), (4, "20240103")]
    found = transform(spark.createDataFrame(rows, "row_id int, order_date string"), keep_unread=True)
    assert [(r.row_id, r.order_date_unread) for r in unread_lines(found).collect()] == [(2, "soon")]
    report = {r.check_name: r.failed_rows for r in quality_report(found).collect()}
    assert (report["order_date_readable"], report["order_date_not_null"]) == (1, 2)


def test_days_in_other_formats(spark):
    texts = "2024-02-29 20240229 2024/02/29 2024/2/29 02/29/2024|Feb 29 2024|Feb 29, 2024|29 Feb 2024"
    head, *tail = texts.split("|")
    rows = [(t,) for t in [*head.split(), *tail, "29.02.2024", "2024-13-01", "", None]]
    got = spark.createDataFrame(rows, "t string").select("t", to_day(F.col("t")).alias("d")).collect()
    assert [r.d for r in got] == [dt.date(2024, 2, 29)] * 8 + [None] * 4


def test_money_finer_than_a_cent(spark):
    total = spark.range(1000).select(F.lit(0.004).alias("m")).agg(money_sum(F.col("m")).alias("m"))
    assert total.first().m == 4.0
    third = spark.range(3).select(F.lit(0.0033).alias("m")).agg(round2(money_sum(F.col("m"))).alias("m"))
    assert third.first().m == 0.01


def test_customer_pool_is_unique_and_grows(spark):
    small = customer_pool(spark, 100)
    large = customer_pool(spark, 200_000)
    assert large.select("customer_id").distinct().count() == 200_000
    assert small.exceptAll(large).isEmpty()
    assert {r.segment for r in small.select("segment").distinct().collect()} == set(SEGMENTS)


def test_synthetic_lines_keep_their_contract(spark, lines):
    assert lines.columns == SALES.fieldNames()[:19]
    broken = lines.where(
        ~F.col("order_date").between(F.lit(START), F.lit(END))
        | ~F.date_diff("ship_date", "order_date").between(1, 7)
        | ~F.col("ship_mode").isin(SHIP_MODES)
        | (F.col("discount") != discount_tier(F.col("quantity")))
        | ~F.col("order_id").rlike(r"^US-2024-[1-9]\d{5}$")
        | ~F.col("postal_code").rlike(r"^\d{3}[1-9]\d$")
    )
    assert broken.isEmpty()
    sizes = lines.agg(
        F.count_distinct("row_id"),
        F.min("row_id"),
        F.max("row_id"),
        F.count_distinct("customer_id"),
        F.count_distinct("city"),
        F.count_distinct("order_date"),
        F.count_distinct("product_id"),
    ).first()
    assert tuple(sizes) == (6000, 1, 6000, 50, len(CITIES), 91, 5)
    top = {r[0]: r[1] for r in lines.groupBy("category").agg(F.max("quantity")).collect()}
    assert top == {"Furniture": 2, "Technology": 12, "Office Supplies": 50}


def test_synthetic_choice_is_uniform_by_level(lines):
    """A category has a third of the lines however many products it has."""
    counts = {r[0]: r[1] for r in lines.groupBy("product_id").count().collect()}
    assert counts["TEC-PH-1"] == pytest.approx(2000, rel=0.1)
    assert counts["FUR-DE-1"] == pytest.approx(1000, rel=0.15)
    assert counts["FUR-CH-1"] == pytest.approx(500, rel=0.2)


def test_synthetic_customers_take_turns(lines):
    per_customer = {r[0] for r in lines.groupBy("customer_id").count().select("count").collect()}
    assert per_customer == {120}


def test_synthetic_lines_do_not_depend_on_partitions_or_length(spark, catalog_path, lines):
    again = synthetic_sales(spark, 100, read_catalog(spark, catalog_path), START, END, 50)
    assert again.exceptAll(lines.where("row_id <= 100")).isEmpty()
    other = synthetic_sales(spark, 100, read_catalog(spark, catalog_path), START, END, 50, seed=7)
    assert not other.exceptAll(lines).isEmpty()


def test_same_day_shipping(spark):
    df = spark.createDataFrame(
        [(START, START), (START, END)], "ordered date, shipped date"
    )
    mode = ship_mode(F.col("ordered"), F.col("shipped"), F.lit(1))
    assert [r[0] for r in df.select(mode).collect()] == ["Same Day", "Second Class"]


@pytest.mark.parametrize(
    "quantity, discount", [(1, 0.0), (4, 0.0), (5, 0.05), (20, 0.1), (99, 0.1), (100, 0.15)]
)
def test_discount_tier(spark, quantity, discount):
    assert spark.range(1).select(discount_tier(F.lit(quantity))).first()[0] == discount


def test_arguments(spark, catalog_path, tmp_path):
    with pytest.raises(ValueError, match="num_synthetic_rows must be >= 1"):
        run_batch(spark, catalog_path, str(tmp_path), num_synthetic_rows=0)
    with pytest.raises(ValueError, match="start_date must be <= end_date"):
        run_batch(
            spark,
            catalog_path,
            str(tmp_path),
            start_date=dt.date(2024, 2, 1),
            end_date=dt.date(2024, 1, 1),
        )


@pytest.fixture(scope="module")
def batch(spark, catalog_path, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("output"))
    result = run_batch(
        spark, catalog_path, folder, 3000, START, END, num_customers=40, database="batch_full"
    )
    return folder, result


def test_batch_outputs(spark, batch):
    folder, result = batch
    assert result.sales.count() == 3000
    assert result.sales.columns == SALES.fieldNames()
    assert len(result.quality) == 9 and all(result.quality.values())
    stored = spark.read.text(f"{result.reports}/quality_report.json").first()[0]
    assert json.loads(stored) == result.quality
    for name, table in result.summaries.items():
        read_back = read_summary(spark, f"{result.reports}/{name}.csv", SUMMARIES[name])
        assert sorted(read_back.collect()) == sorted(table.collect())
    sample = spark.read.schema(SALES).option("header", True).csv(f"{result.reports}/sample_data.csv")
    assert sorted(r.row_id for r in sample.collect()) == list(range(1, 51))
    # Leading zeros survive the CSV.
    assert sample.where("city = 'Boston'").where("postal_code NOT LIKE '021__'").isEmpty()


def test_reports_of_one_run_count_together(spark, batch, catalog_path, tmp_path, monkeypatch):
    """A run that dies between two of its outputs leaves the set of the run before it, or none."""
    folder, options = str(tmp_path), dict(build_star_schema=False, database="batch_reports")
    with monkeypatch.context() as patched:
        patched.setattr(files, "write_quality", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(spark, catalog_path, folder, 60, START, END, **options)
        assert read_reports(spark, folder) is None
    run_batch(spark, catalog_path, folder, 70, START, END, **options)
    with monkeypatch.context() as patched:
        patched.setattr(files, "write_quality", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            run_batch(spark, catalog_path, folder, 80, START, END, **options)
    found = read_reports(spark, folder)
    assert found["sales"].count() == 70
    assert found["yearly"].first().total_orders == 70
    assert found["sample_data"].count() == 50 and found["quality_report"].count() == 9
    # What the killed runs left is gone with the next one that ends.
    run_batch(spark, catalog_path, folder, 90, START, END, **options)
    assert len(os.listdir(f"{folder}/reports")) == 2
    assert read_reports(spark, folder)["yearly"].first().total_orders == 90


def test_second_writer_is_noticed(spark, tmp_path):
    path = str(tmp_path / "reports")
    with pytest.raises(files.AnotherWriter):
        with files.report_set(spark, path, {"silver": "a"}):
            with files.report_set(spark, path, {"silver": "b"}):
                pass
    assert files.read_manifest(spark, path)["silver"] == "b"


def test_batch_star(batch, spark):
    _, result = batch
    if result.star_error:
        # Postal codes repeat within a city, never across regions, so the keys must hold.
        pytest.fail(result.star_error)
    reports = validate(result.star)
    counts = reports["row_counts"].first()
    assert counts.fact_sales == counts.original_sales == 3000
    assert (counts.dim_customer, counts.dim_product, counts.dim_date) == (40, 5, 91)
    coverage = reports["foreign_key_coverage"].first()
    assert set(coverage) == {3000}
    assert reports["ship_date_gap"].first().line_count > 0
    listed = {r.table_name: r.row_count for r in warehouse.list_tables(spark, "batch_full").collect()}
    assert listed["fact_sales"] == 3000 and set(listed) == set(STAR)
    for name, table in result.star.tables().items():
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
        assert schema == STAR[name].replace("  ", " ")
    assert spark.table("batch_full.sales").count() == 3000


def test_dashboard_over_stored_sales(spark, batch):
    folder, result = batch
    board = open_dashboard(spark, f"{folder}/silver", years=[2024], months=[1, 2])
    try:
        kpis = board.panels["kpis"].first()
        months = board.panels["revenue_by_month"].collect()
        regions = board.panels["region"].collect()
        assert [m.year_month for m in months] == ["2024-01", "2024-02"]
        assert kpis.total_revenue == pytest.approx(sum(m.total_revenue for m in months))
        assert kpis.total_revenue == pytest.approx(sum(r.total_revenue for r in regions))
        assert set(board.panels) == {
            "kpis", "revenue_by_month", "orders_by_month", "segment_by_month", "top_customers",
            "cities", "region", "category_by_month", "top_products",
        }
    finally:
        board.close()


def test_silver_folders_are_pruned(spark, batch):
    folder, _ = batch
    january = read_sales(spark, f"{folder}/silver").where("order_year = 2024 AND order_month = 1")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan
    assert len(january.inputFiles()) >= 1


def test_reuse_keeps_the_stored_lines(spark, batch, catalog_path):
    folder, result = batch
    again = run_batch(
        spark,
        catalog_path,
        folder,
        10,
        START,
        END,
        rebuild=False,
        build_star_schema=False,
        database="batch_reuse",
    )
    assert again.sales.count() == 3000
    assert again.star is None and again.star_error is None


def test_failed_star_leaves_sales(spark, batch, tmp_path, catalog_path):
    """A customer with two names is found before any star table is written."""
    folder = str(tmp_path)
    bronze = read_sales(spark, f"{batch[0]}/bronze", SALES)
    files.write_bronze(
        bronze.select(*SALES.fieldNames()[:19]).withColumn(
            "customer_name", F.when(F.col("row_id") == 1, "Other Name").otherwise(F.col("customer_name"))
        ),
        f"{folder}/bronze",
    )
    result = run_batch(
        spark, catalog_path, folder, rebuild=False, database="batch_broken"
    )
    assert result.star is None
    assert "dim_customer (customer_id): 1 repeated keys" in result.star_error
    refused = result.refused.collect()
    assert [(r.table_name, r.key_columns, r.row_count) for r in refused] == [("dim_customer", "customer_id", 2)]
    assert refused[0].line_count == bronze.where(F.col("customer_id") == refused[0].key_value).count()
    assert refused[0].first_row_id == 1
    assert [t.name for t in spark.catalog.listTables("batch_broken")] == ["sales"]
    assert warehouse.list_tables(spark, "batch_broken").count() == 0


def test_later_session_attaches_and_overwrites(spark, catalog_path, tmp_path):
    """An earlier session's tables are files that this session's catalog does not know."""
    folder = str(tmp_path)
    run_batch(spark, catalog_path, folder, 200, START, END, database="first_session")
    tables = attach(spark, folder, "later_session")
    assert set(tables) == {*STAR, "sales"}
    assert tables["fact_sales"].count() == tables["sales"].count() == 200
    revenue = spark.sql(
        "SELECT SUM(f.sales_amount) AS a FROM later_session.fact_sales f "
        "JOIN later_session.dim_date d ON f.order_date_key = d.date_key"
    ).first()
    assert revenue.a == pytest.approx(tables["sales"].agg(F.sum("revenue")).first()[0])
    again = run_batch(spark, catalog_path, folder, 300, START, END, database="third_session")
    assert again.star_error is None
    assert again.star.fact_sales.count() == 300


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Run the batch job first"):
        read_sales(spark, str(tmp_path / "none"))
    assert read_summary(spark, str(tmp_path / "none.csv"), SUMMARIES["yearly"]) is None


def test_sales_as_sql_view(spark, lines):
    lines.createOrReplaceTempView("sales_data")
    try:
        assert spark.sql("SELECT count(*) FROM sales_data").first()[0] == 6000
    finally:
        spark.catalog.dropTempView("sales_data")


def test_first_rows(spark, batch):
    stored = read_sales(spark, f"{batch[0]}/silver")
    assert [r.row_id for r in files.first_rows(stored, 7).collect()] == list(range(1, 8))
    assert files.first_rows(stored.limit(0), 7).count() == 0


def test_scratch_can_be_cleared(spark):
    table = scratch.materialize(spark.range(3), "numbers")
    assert table.count() == 3
    assert table.inputFiles()[0].startswith(("file:", "/"))
    scratch.clear(spark)
    with pytest.raises(FileNotFoundError):
        read_sales(spark, table.inputFiles()[0])


def fake_session(**settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key.split(".")[-2], default)),
        sparkContext=SimpleNamespace(applicationId="app", getCheckpointDir=lambda: None),
    )


def test_scratch_folder_follows_the_session():
    named = fake_session(checkpoint="hdfs://shared/checkpoints/", warehouse="/house")
    assert scratch.root(named) == "hdfs://shared/checkpoints/salesloom/app"
    assert scratch.root(fake_session(warehouse="/house")) == "/house/_scratch/salesloom/app"


def test_long_synthesis_has_many_tasks(spark, catalog_path):
    catalog = read_catalog(spark, catalog_path)
    ids = synthetic_sales(spark, 10_000_000_000, catalog, START, END)
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "splits=Some(5000)" in ids._jdf.queryExecution().optimizedPlan().toString() or "splits=5000" in plan


def test_unfinished_folder_is_not_read(spark, catalog_path, tmp_path):
    """What a killed write leaves: no mark, whatever else is there."""
    folder = str(tmp_path)
    version = files.write_bronze(spark.range(1).toDF("row_id"), f"{folder}/bronze")
    (tmp_path / "bronze" / version.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    (tmp_path / "other" / "_temporary").mkdir(parents=True)
    for name in ("bronze", "other"):
        with pytest.raises(FileNotFoundError):
            read_sales(spark, f"{folder}/{name}")
    result = run_batch(
        spark, catalog_path, folder, 50, START, END, rebuild=False, build_star_schema=False, database="unfinished"
    )
    assert result.sales.count() == 50


def test_failed_star_write_serves_no_mixed_star(spark, catalog_path, tmp_path, monkeypatch):
    folder = str(tmp_path)
    run_batch(spark, catalog_path, folder, 200, START, END, database="mixed")
    assert {*STAR} <= set(attach(spark, folder, "mixed"))

    finish = versions.finish

    def fail(spark, version):
        if "/warehouse/" in version:
            raise OSError("disk full")
        finish(spark, version)

    monkeypatch.setattr("salesloom.versions.finish", fail)
    second = run_batch(spark, catalog_path, folder, 100, START, END, seed=7, database="mixed")
    monkeypatch.undo()
    assert second.star is None and "disk full" in second.star_error
    assert {t.name for t in spark.catalog.listTables("mixed")} == {"sales"}
    tables = attach(spark, folder, "mixed_later")
    assert set(tables) == {"sales"} and tables["sales"].count() == 100
    third = run_batch(spark, catalog_path, folder, 150, START, END, database="mixed")
    assert third.star.fact_sales.count() == 150
    assert len(list((tmp_path / "silver").glob("v-*"))) == 2


def test_failed_bronze_keeps_the_earlier_one(spark, batch):
    folder, _ = batch
    broken = spark.range(10).select(F.raise_error(F.lit("lost")).cast("bigint").alias("row_id"))
    with pytest.raises(Exception, match="lost"):
        files.write_bronze(broken, f"{folder}/bronze")
    assert read_sales(spark, f"{folder}/bronze", SALES).count() == 3000


@pytest.fixture(scope="module")
def odd_silver(spark, batch, tmp_path_factory):
    """Stored lines with nulls in every column the panels read, and orders of several months."""
    path = str(tmp_path_factory.mktemp("odd") / "silver")
    lines = read_sales(spark, f"{batch[0]}/silver").where("row_id <= 900")
    holes = {
        c: F.when(F.col("row_id") % (13 + i) != 0, F.col(c)).alias(c)
        for i, c in enumerate(("order_id", "customer_id", "product_id", "city", "product_name", "region", "order_month"))
    }
    holes["order_id"] = F.when(F.col("row_id") % 13 != 0, F.concat(F.lit("o"), F.col("row_id") % 40)).alias("order_id")
    files.write_silver(lines.select(*[holes.get(c, F.col(c)) for c in lines.columns]), path)
    return path


@pytest.mark.parametrize("period", [{}, {"years": [2024], "months": [2, 3, 7]}, {"months": []}, {"years": [1990]}])
def test_cubes_answer_like_the_lines(spark, odd_silver, period):
    board = open_dashboard(spark, odd_silver, **period)
    lines = panels.filter_period(read_sales(spark, odd_silver), **period)
    by_lines = panels.panels(lines)
    assert set(by_lines) == set(board.panels)
    for name, panel in by_lines.items():
        assert board.panels[name].collect() == panel.collect(), name
        assert board.panels[name].columns == panel.columns


def test_second_opening_reads_no_lines(spark, odd_silver):
    open_dashboard(spark, odd_silver)
    before = versions.current(spark, cube_folder(odd_silver, versions.current(spark, odd_silver)))
    board = open_dashboard(spark, odd_silver, months=[1])
    assert versions.current(spark, cube_folder(odd_silver, versions.current(spark, odd_silver))) == before
    for panel in board.panels.values():
        files_read = panel.inputFiles()
        assert files_read and all("/silver_cubes/" in f for f in files_read)
        assert "Expand" not in panel._jdf.queryExecution().executedPlan().toString()


def test_new_lines_get_new_cubes(spark, batch, tmp_path):
    path = str(tmp_path / "silver")
    lines = read_sales(spark, f"{batch[0]}/silver")
    for n in (10, 20, 30, 40, 50):
        files.write_silver(lines.where(f"row_id <= {n}"), path)
        assert open_dashboard(spark, path).panels["kpis"].first().total_orders == n
    assert len(os.listdir(f"{path}_cubes")) == 3


def test_unfinished_cubes_are_not_read(spark, batch, tmp_path, monkeypatch):
    path = str(tmp_path / "silver")
    files.write_silver(read_sales(spark, f"{batch[0]}/silver").where("row_id <= 10"), path)
    with monkeypatch.context() as patched:
        patched.setattr(versions, "finish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            open_dashboard(spark, path)
    assert open_dashboard(spark, path).panels["kpis"].first().total_orders == 10
    folder = cube_folder(path, versions.current(spark, path))
    assert len(os.listdir(folder)) == 1


def test_cubes_keep_ids_not_lines(spark, tmp_path, monkeypatch):
    """What is stored on the way grows with customers, products and orders of several months only."""
    lines = spark.range(2400).selectExpr(
        "2024 AS order_year", "int(id % 12) + 1 AS order_month", "1.25D AS revenue", "1 AS quantity",
        "string(id % 1200) AS order_id", "string(id % 20) AS customer_id", "string(id % 20) AS customer_name",
        "string(id % 30) AS product_id", "string(id % 30) AS product_name", "'s' AS segment", "'c' AS category",
        "string(id % 7) AS city", "'r' AS region",
    )
    kept, write = [], scratch.materialize
    monkeypatch.setattr(scratch, "materialize", lambda df, name: kept.append(df.count()) or write(df, name))
    cubes.store(lines, str(tmp_path / "cubes"))
    assert sum(kept) == 2 * (20 + 30)
    assert spark.read.parquet(str(tmp_path / "cubes/item")).selectExpr("sum(cube_orders)").first()[0] == 1200
    assert spark.read.parquet(str(tmp_path / "cubes/item_returning")).count() == 0


def test_finished_columns_are_not_shuffled(spark, tmp_path):
    lines = spark.range(50).selectExpr(
        "2024 AS order_year", "int(id % 3) + 1 AS order_month", "id AS row_id", "id + 0.25D AS price", "2 AS quantity", "0.1D AS discount"
    )
    seen = []
    files.write_silver(lines, str(tmp_path / "silver"), lambda df: seen.append(df.columns) or with_amounts(df))
    assert seen == [lines.columns]
    stored = read_sales(spark, str(tmp_path / "silver")).select("row_id", "revenue", "gross_sales", "discount_amount")
    want = with_amounts(lines).select(*stored.columns)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, want.collect()))
