"""Every query by name, over a folder of source tables."""

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import scratch, versions
from salesloom.functions import money_sum, round2
from salesloom.operators import panels, star, summaries
from salesloom.plans import batch
from salesloom.plans.dashboard import open_dashboard
from salesloom.operators.clean import (
    clean,
    drop_duplicates,
    null_profile,
    transform,
    unread_lines,
    with_amounts,
    with_order_period,
)
from salesloom.operators.quality import quality_report
from salesloom.schemas import CATALOG_JSON, SALES, SUMMARIES
from salesloom.sinks import files, warehouse
from salesloom.sources import tpch
from salesloom.sources.catalog import nest_catalog, read_catalog
from salesloom.sources.files import read_sales, read_summary
from salesloom.sources.synthetic import (
    CITIES,
    SEGMENTS,
    SHIP_MODES,
    discount_tier,
    quantity_limit,
    synthesize,
)

Query = Callable[[SparkSession, str], DataFrame]

CATALOGUE_DATABASE = "salesloom_catalogue"
PERIOD = {"years": [1996, 1997, 1998], "months": [1, 2, 3, 4, 5, 6]}


def sales(spark: SparkSession, base: str, between: tpch.Between = None) -> DataFrame:
    return transform(clean(tpch.sales(spark, base, between)))


def dirty(spark: SparkSession, base: str) -> DataFrame:
    return transform(clean(tpch.dirty_sales(spark, base)))


def stored_dirty(spark: SparkSession, base: str) -> DataFrame:
    """Enriched lines with row ids, read from a written table."""
    return transform(clean(tpch.numbered_dirty_sales(spark, base)))


def full_star(spark: SparkSession, base: str) -> star.Star:
    return star.build_star(with_order_period(clean(tpch.numbered_sales(spark, base))), with_amounts)


def full_star_dirty(spark: SparkSession, base: str) -> star.Star:
    return star.build_star(with_order_period(clean(tpch.numbered_dirty_sales(spark, base))), with_amounts)


def on_sales(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, base: operator(sales(spark, base))


def on_dirty(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, base: operator(dirty(spark, base))


def on_period(operator: Callable[[DataFrame], DataFrame], **period) -> Query:
    """The operator over a selection; all years and months unless told otherwise."""

    def query(spark: SparkSession, base: str) -> DataFrame:
        lines = sales(spark, base, panels.period_bounds(**period))
        return operator(panels.filter_period(lines, **period))

    return query


def with_unread(spark: SparkSession, base: str) -> DataFrame:
    """Dirty lines that keep the text of days nobody could read."""
    return transform(clean(tpch.dirty_sales(spark, base)), keep_unread=True)


def unread_days(spark: SparkSession, base: str) -> DataFrame:
    return unread_lines(with_unread(spark, base)).select("order_id", "product_id", "order_date_unread")


def partial_columns(spark: SparkSession, base: str) -> DataFrame:
    """Checks of lines without discounts and days: each step skips what is not there."""
    return quality_report(transform(clean(tpch.dirty_sales(spark, base).drop("discount", "order_date"))))


def partial_summaries(spark: SparkSession, base: str) -> DataFrame:
    """Names and sizes of the summaries that lines without a region still have."""
    found = summaries.build_summaries(sales(spark, base).drop("region"))
    sizes = [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("summary"), "rows") for n, t in found.items()]
    return reduce(DataFrame.unionByName, sizes)


def clean_numeric(spark: SparkSession, base: str) -> DataFrame:
    return clean(tpch.dirty_sales(spark, base)).select(
        "order_id", "product_id", "price", "quantity", "discount"
    )


def distinct_orders(spark: SparkSession, base: str) -> DataFrame:
    lines = tpch.sales(spark, base).select(
        "order_id", "order_date", "ship_mode", "customer_id", "segment"
    )
    return drop_duplicates(lines)


def dim_date(spark: SparkSession, base: str) -> DataFrame:
    return star.dim_date(tpch.sales(spark, base))


def fact_sales(spark: SparkSession, base: str) -> DataFrame:
    return full_star(spark, base).fact_sales


def fact_sales_dirty(spark: SparkSession, base: str) -> DataFrame:
    return full_star_dirty(spark, base).fact_sales


def star_row_counts(spark: SparkSession, base: str) -> DataFrame:
    return star.row_counts(full_star(spark, base))


def fk_coverage(raw: Query) -> Query:
    """Coverage needs no row ids; the lines are stored once for the dimensions and the joins."""

    def query(spark: SparkSession, base: str) -> DataFrame:
        lines = scratch.materialize(raw(spark, base), "sales")
        keyed = star.with_dimension_keys(lines, *star.dimensions(lines))
        return star.foreign_key_coverage(star.with_date_keys(keyed))

    return query


def star_key_problems(spark: SparkSession, base: str) -> DataFrame:
    return star.key_problems(full_star(spark, base))


def star_key_problems_dirty(spark: SparkSession, base: str) -> DataFrame:
    return star.key_problems(full_star_dirty(spark, base))


def stored_dates(spark: SparkSession, base: str) -> DataFrame:
    """One pass over the lines; the calendar's bounds and its questions then read a small table."""
    return scratch.materialize(star.by_dates(sales(spark, base)), "dates")


def star_ship_date_gap(spark: SparkSession, base: str) -> DataFrame:
    dates = stored_dates(spark, base)
    return star.ship_date_gap(star.with_date_keys(dates), star.dim_date(dates), F.sum("line_count"))


def star_revenue_by_month(spark: SparkSession, base: str) -> DataFrame:
    """Only the fact's date key and amount are needed, so no dimension is joined for its key."""
    dates = stored_dates(spark, base)
    return star.revenue_by_month(star.with_date_keys(dates), star.dim_date(dates), F.sum("amount"))


def dim_customer_first(spark: SparkSession, base: str) -> DataFrame:
    return star.dim_customer(sales(spark, base)).orderBy("customer_key").limit(10)


def dim_product_category(spark: SparkSession, base: str) -> DataFrame:
    return star.dim_product(sales(spark, base)).where(F.col("category") == "PROMO")


def dim_location_region(spark: SparkSession, base: str) -> DataFrame:
    return star.dim_location(sales(spark, base)).where(F.col("region") == "ASIA")


def dim_date_year(spark: SparkSession, base: str) -> DataFrame:
    return dim_date(spark, base).where(F.col("year") == 1997)


def fact_sales_first(spark: SparkSession, base: str) -> DataFrame:
    return fact_sales(spark, base).orderBy("sales_key").limit(10)


def sample_rows(spark: SparkSession, base: str) -> DataFrame:
    return transform(clean(tpch.first_sales(spark, base, 50)))


def part_products(spark: SparkSession, base: str) -> DataFrame:
    """The part table with the columns of a catalog."""
    columns = {"category": "p_type", "sub_category": "p_brand", "product_name": "p_name", "price": "p_retailprice"}
    columns["product_id"] = tpch.SALES_COLUMNS["product_id"]
    return tpch.read(spark, base, "part").selectExpr(
        "p_partkey", *[f"{expression} AS {name}" for name, expression in columns.items()]
    )


def stored_catalog(spark: SparkSession, base: str) -> str:
    """The parts as a file of nested documents of 500 products or fewer, a document a line."""
    path = scratch.new_path(spark, "catalog")
    nest_catalog(part_products(spark, base), F.floor(F.col("p_partkey") / 500)).write.text(path)
    return path


def catalog_flatten(spark: SparkSession, base: str) -> DataFrame:
    return read_catalog(spark, stored_catalog(spark, base), lines=True)


def catalog_nesting(spark: SparkSession, base: str) -> DataFrame:
    """How deep the stored documents are: categories, sub-categories and products of each."""
    documents = spark.read.text(stored_catalog(spark, base)).withColumn("document", F.monotonically_increasing_id())
    nested = documents.select(F.from_json("value", CATALOG_JSON).alias("catalog"))
    groups = F.flatten(F.transform(F.map_values("catalog"), F.map_values))
    sizes = nested.select(
        F.size("catalog").alias("categories"),
        F.size(groups).alias("sub_categories"),
        F.size(F.flatten(groups)).alias("products"),
    )
    return sizes.groupBy("categories", "sub_categories", "products").agg(F.count("*").alias("documents"))


def synth_sales(spark: SparkSession, base: str) -> DataFrame:
    """One synthetic line per event, products from the part table, as many customers as exist."""
    ids = tpch.read(spark, base, "events").select((F.col("event_id") + 1).alias("row_id"))
    catalog = part_products(spark, base).drop("p_partkey")
    customers = tpch.read(spark, base, "customer").count()
    return synthesize(ids, catalog, *order_days(spark, base), customers)


def order_days(spark: SparkSession, base: str) -> tuple[date, date]:
    day = F.to_date("o_orderdate")
    return tuple(tpch.read(spark, base, "orders").agg(F.min(day), F.max(day)).first())


def synth_contract(spark: SparkSession, base: str) -> DataFrame:
    """Rows that break a rule of the synthesis, and sizes that the source tables fix."""
    products = part_products(spark, base).select(
        "category", "sub_category", "product_name", "product_id", F.lit(True).alias("_sold")
    )
    lines = synth_sales(spark, base).join(
        products, ["category", "sub_category", "product_name", "product_id"], "left"
    )
    first_day, last_day = order_days(spark, base)
    latency = F.date_diff("ship_date", "order_date")
    place = F.concat_ws("|", "city", "state", F.substring("postal_code", 1, 3), "region")
    broken = {
        "order_date": ~F.col("order_date").between(F.lit(first_day), F.lit(last_day)),
        "product": F.col("_sold").isNull(),
        "ship_mode": ~F.col("ship_mode").isin("Same Day", *SHIP_MODES),
        "segment": ~F.col("segment").isin(SEGMENTS),
        "place": ~place.isin(["|".join(city) for city in CITIES]),
        "ship_latency": ~latency.between(1, 7),
        "quantity": ~F.col("quantity").between(1, quantity_limit(F.col("category"))),
        "discount": F.col("discount") != discount_tier(F.col("quantity")),
        "order_id": ~F.col("order_id").rlike(r"^US-\d{4}-[1-9]\d{5}$")
        | (F.substring("order_id", 4, 4) != F.year("order_date").cast("string")),
        "customer_id": ~F.col("customer_id").rlike(r"^[A-Z]{2}-\d{5,}$"),
        "postal_code": ~F.col("postal_code").rlike(r"^\d{5}$"),
        "price": F.col("price") != round2(F.col("price")),
    }
    measures = {"rows": F.count("*"), "customers": F.count_distinct("customer_id")}
    measures |= {f"broken_{name}": F.count_if(rule) for name, rule in broken.items()}
    return lines.agg(*[m.alias(name) for name, m in measures.items()])


def synth_rotation(spark: SparkSession, base: str) -> DataFrame:
    """Lines per customer: customers take turns, so the numbers differ by one at most."""
    per_customer = synth_sales(spark, base).groupBy("customer_id").agg(F.count("*").alias("n"))
    return per_customer.agg(F.min("n").alias("fewest"), F.max("n").alias("most"))


def unrounded_revenue(spark: SparkSession, base: str) -> DataFrame:
    """Amounts finer than a cent, rounded once after they are added."""
    amount = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = tpch.read(spark, base, "lineitem").groupBy("l_returnflag")
    return lines.agg(round2(money_sum(amount)).alias("revenue"))


def summary_csv_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    name = "top_products"
    folder = scratch.new_path(spark, "summaries")
    files.write_summaries({name: summaries.top_products(sales(spark, base))}, folder)
    return read_summary(spark, f"{folder}/{name}.csv", SUMMARIES[name])


def silver_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    """Raw lines stored, enriched from the store, and stored again by month."""
    folder = scratch.new_path(spark, "lake")
    raw = tpch.sales(spark, base)
    files.write_bronze(raw, f"{folder}/bronze")
    bronze = read_sales(spark, f"{folder}/bronze", raw.schema)
    files.write_silver(with_order_period(clean(bronze)), f"{folder}/silver", with_amounts)
    columns = [field for field in SALES if field.name != "row_id"]
    return read_sales(spark, f"{folder}/silver", type(SALES)(columns))


def sample_csv_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    path = scratch.new_path(spark, "sample")
    first = scratch.materialize(sample_rows(spark, base), "sample")
    files.write_sample(first, path)
    return spark.read.schema(first.schema).option("header", True).csv(path)


def quality_json_roundtrip(spark: SparkSession, base: str) -> DataFrame:
    path = scratch.new_path(spark, "quality")
    files.write_quality(quality_report(dirty(spark, base)), path)
    verdicts = F.from_json("value", "map<string,boolean>")
    return spark.read.text(path).select(F.explode(verdicts).alias("check_name", "passed"))


# The star an earlier query of this application has saved, by application and folder.
_saved_stars: dict[tuple, str] = {}


def saved_star(spark: SparkSession, base: str) -> str:
    """The star saved once to the database of the catalogue, whose name is returned."""
    key = (spark.sparkContext.applicationId, base)
    version = _saved_stars.get(key)
    warehouse.create_database(spark, CATALOGUE_DATABASE)
    if version is None or not versions.is_complete(spark, version):
        version = versions.new(scratch.new_path(spark, "warehouse"))
        built = full_star(spark, base)
        warehouse.save_star(built, version, CATALOGUE_DATABASE)
        scratch.drop(built.sales)
        _saved_stars[key] = version
    else:
        warehouse.attach_star(spark, version, CATALOGUE_DATABASE)
    return CATALOGUE_DATABASE


def refused_star(spark: SparkSession, base: str) -> DataFrame:
    """What the load step answers to lines whose keys repeat: the verdict, and no tables."""
    database = f"{CATALOGUE_DATABASE}_refused"
    warehouse.create_database(spark, database)
    version = versions.new(scratch.new_path(spark, "refused"))
    try:
        batch.load_star(spark, stored_dirty(spark, base), version, database)
    except batch.StarRefused as refusal:
        return refusal.verdict
    return spark.createDataFrame([], star.VERDICT)


def batch_run(pick: Callable[[batch.BatchResult], DataFrame], again: bool = False) -> Query:
    """The whole batch job: as many lines as events, sold from the parts to as many customers as there
    are. With ``again`` it runs a second time over the lines it has stored."""

    def query(spark: SparkSession, base: str) -> DataFrame:
        folder = scratch.new_path(spark, "job")
        path = stored_catalog(spark, base)
        first, last = order_days(spark, base)
        rows, customers = (tpch.read(spark, base, t).count() for t in ("events", "customer"))
        options = dict(
            num_customers=customers,
            build_star_schema=False,
            database=f"{CATALOGUE_DATABASE}_job",
            catalog_lines=True,
        )
        result = batch.run_batch(spark, path, folder, rows, first, last, **options)
        if again:
            result = batch.run_batch(spark, path, folder, 1, first, last, rebuild=False, **options)
        return pick(result)

    return query


def stored_star_sql(spark: SparkSession, base: str) -> DataFrame:
    """The batch job's own load steps over stored silver: register, build, check, write, query."""
    folder = scratch.new_path(spark, "lake")
    database = f"{CATALOGUE_DATABASE}_batch"
    numbered = with_order_period(clean(tpch.numbered_sales(spark, base)))
    written = files.write_silver(numbered, f"{folder}/silver", with_amounts)
    scratch.drop(numbered)
    warehouse.create_database(spark, database)
    warehouse.register_sales(spark, f"{folder}/silver", database)
    lines = warehouse.read_table(spark, "sales", database)
    batch.load_star(spark, lines, batch.star_version(folder, written), database, with_amounts)
    return spark.sql(
        f"""
        SELECT l.region, d.year, COUNT(*) AS line_count,
          CAST(SUM(CAST(f.sales_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue,
          CAST(SUM(CAST(s.revenue AS DECIMAL(18, 2))) AS DOUBLE) AS sales_revenue
        FROM {database}.fact_sales f
        JOIN {database}.dim_location l ON f.location_key = l.location_key
        JOIN {database}.dim_date d ON f.order_date_key = d.date_key
        JOIN {database}.sales s ON f.sales_key = s.row_id
        GROUP BY l.region, d.year
        """
    )


def stored_panel(panel: Callable[[DataFrame], DataFrame], **period) -> Query:
    """A dashboard panel over stored silver, where the period prunes folders."""

    def query(spark: SparkSession, base: str) -> DataFrame:
        path = scratch.new_path(spark, "silver")
        lines = sales(spark, base).withColumn("row_id", F.lit(None).cast("bigint"))
        files.write_silver(lines, path)
        return panel(panels.filter_period(read_sales(spark, path), **period))

    return query


# Silver that an earlier query of this application has stored, by application, folder and view.
_stored_silver: dict[tuple, str] = {}


def silver_of(spark: SparkSession, base: str, raw: Query) -> str:
    """Stored silver of a view of the source tables, written once for all queries that share it."""
    key = (spark.sparkContext.applicationId, base, raw)
    path = _stored_silver.get(key)
    if path is None or versions.current(spark, path) is None:
        path = f"{scratch.new_path(spark, 'dashboard')}/silver"
        lines = raw(spark, base).drop("revenue", "discount_amount", "gross_sales")
        files.write_silver(lines.withColumn("row_id", F.lit(None).cast("bigint")), path, with_amounts)
        _stored_silver[key] = path
    return path


def dashboard(panel: str, raw: Query = sales, **period) -> Query:
    """A panel of a dashboard over stored silver, whose cubes the first opening has stored."""

    def query(spark: SparkSession, base: str) -> DataFrame:
        return open_dashboard(spark, silver_of(spark, base, raw), **period).panels[panel]

    return query


def warehouse_tables(spark: SparkSession, base: str) -> DataFrame:
    return warehouse.list_tables(spark, saved_star(spark, base))


def warehouse_sql(spark: SparkSession, base: str) -> DataFrame:
    """Revenue by month and category as a user writes it against the saved tables."""
    database = saved_star(spark, base)
    return spark.sql(
        f"""
        SELECT d.year, d.month, d.month_name, p.category,
          CAST(SUM(CAST(f.sales_amount AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
        FROM {database}.fact_sales f
        JOIN {database}.dim_date d ON f.order_date_key = d.date_key
        JOIN {database}.dim_product p ON f.product_key = p.product_key
        GROUP BY d.year, d.month, d.month_name, p.category
        ORDER BY d.year, d.month, p.category
        """
    )


def on_cube(panel: Callable[[DataFrame], DataFrame], raw: Query = sales) -> Query:
    """A panel read from the stored monthly cube instead of the lines."""

    def query(spark: SparkSession, base: str) -> DataFrame:
        selection = panels.filter_period(raw(spark, base))
        return panel(scratch.materialize(panels.monthly_cube(selection), "monthly"))

    return query


def text_table(panel: Callable[[DataFrame], DataFrame]) -> Query:
    return on_period(lambda df: panels.display_table(panel(df)))


QUERIES: dict[str, Query] = {
    "sales_view": tpch.sales,
    "dirty_sales_view": tpch.dirty_sales,
    "clean_numeric": clean_numeric,
    "null_profile": lambda spark, base: null_profile(tpch.dirty_sales(spark, base)),
    "parse_order_date": on_dirty(
        lambda df: df.select("order_id", "order_date", "order_year", "order_month")
    ),
    "derive_metrics": sales,
    "derive_metrics_dirty": dirty,
    "filter_year_month": on_period(lambda df: df, **PERIOD),
    "filter_options": on_sales(panels.filter_options),
    "drop_duplicates": distinct_orders,
    "summary_yearly": on_sales(summaries.yearly),
    "summary_regional": on_sales(summaries.regional_revenue),
    "summary_top_products": on_sales(summaries.top_products),
    "summary_segment_yearly": on_sales(summaries.segment_yearly),
    "summary_yearly_dirty": on_dirty(summaries.yearly),
    "summary_regional_dirty": on_dirty(summaries.regional_revenue),
    "quality_report": on_sales(quality_report),
    "quality_report_dirty": on_dirty(quality_report),
    "quality_report_unread": lambda spark, base: quality_report(with_unread(spark, base)),
    "quality_report_partial": partial_columns,
    "unread_days": unread_days,
    "summaries_partial": partial_summaries,
    "dim_customer": on_sales(star.dim_customer),
    "dim_product": on_sales(star.dim_product),
    "dim_location": on_sales(star.dim_location),
    "dim_location_dirty": on_dirty(star.dim_location),
    "dim_date": dim_date,
    "fact_sales": fact_sales,
    "fact_sales_dirty": fact_sales_dirty,
    "star_row_counts": star_row_counts,
    "star_fk_coverage": fk_coverage(sales),
    "star_fk_coverage_dirty": fk_coverage(dirty),
    "star_pk_violations": star_key_problems,
    "star_pk_violations_dirty": star_key_problems_dirty,
    "star_ship_date_gap": star_ship_date_gap,
    "star_revenue_by_month": star_revenue_by_month,
    "dim_customer_first": dim_customer_first,
    "dim_attribute_filter": dim_product_category,
    "dim_location_region": dim_location_region,
    "dim_date_year": dim_date_year,
    "fact_sales_first": fact_sales_first,
    "panel_kpis": on_period(panels.kpis),
    "panel_kpis_period": on_period(panels.kpis, **PERIOD),
    "panel_kpis_dirty": on_dirty(lambda df: panels.kpis(panels.filter_period(df))),
    "panel_kpis_text": on_period(panels.kpis_text),
    "panel_revenue_by_month": on_period(panels.revenue_by_month),
    "panel_orders_by_month": on_period(panels.orders_by_month),
    "panel_segment_by_month": on_period(panels.segment_by_month),
    "panel_top_customers": on_period(panels.top_customers),
    "panel_top_customers_text": text_table(panels.top_customers),
    "panel_cities": on_period(panels.cities),
    "panel_cities_text": text_table(panels.cities),
    "panel_region": on_period(panels.revenue_by_region),
    "panel_region_dirty": on_dirty(panels.revenue_by_region),
    "panel_category_by_month": on_period(panels.category_by_month),
    "panel_top_products": on_period(panels.top_products),
    "panel_top_products_text": text_table(panels.top_products),
    "cube_segment_by_month": on_cube(panels.segment_by_month),
    "cube_orders_by_month": on_cube(panels.orders_by_month),
    "cube_region_dirty": on_cube(panels.revenue_by_region, dirty),
    "sample_rows": sample_rows,
    "catalog_flatten": catalog_flatten,
    "catalog_nesting": catalog_nesting,
    "synth_sales": synth_sales,
    "synth_contract": synth_contract,
    "synth_rotation": synth_rotation,
    "summary_csv_roundtrip": summary_csv_roundtrip,
    "silver_roundtrip": silver_roundtrip,
    "sample_csv_roundtrip": sample_csv_roundtrip,
    "quality_json_roundtrip": quality_json_roundtrip,
    "warehouse_tables": warehouse_tables,
    "stored_star_sql": stored_star_sql,
    "stored_panel_kpis": stored_panel(panels.kpis, **PERIOD),
    "stored_panel_cities": stored_panel(panels.cities, **PERIOD),
    "stored_panel_empty": stored_panel(panels.kpis, years=[], months=[1]),
    "star_refused_dirty": refused_star,
    "batch_regional": batch_run(lambda result: result.summaries["regional_revenue"]),
    "batch_reuse_yearly": batch_run(lambda result: result.summaries["yearly"], again=True),
    "batch_quality": batch_run(
        lambda result: batch.quality_frame(result.sales.sparkSession, result.quality)
    ),
    "dashboard_kpis": dashboard("kpis", **PERIOD),
    "dashboard_kpis_dirty": dashboard("kpis", dirty),
    "dashboard_empty": dashboard("kpis", years=[], months=[1]),
    "dashboard_cities": dashboard("cities", **PERIOD),
    "dashboard_top_products_dirty": dashboard("top_products", dirty),
    "dashboard_top_customers": dashboard("top_customers", **PERIOD),
    "dashboard_category_by_month_dirty": dashboard("category_by_month", dirty),
    "panel_cities_dirty": on_dirty(lambda df: panels.cities(panels.filter_period(df))),
    "panel_top_products_dirty": on_dirty(lambda df: panels.top_products(panels.filter_period(df))),
    "panel_category_by_month_dirty": on_dirty(
        lambda df: panels.category_by_month(panels.filter_period(df))
    ),
    "unrounded_revenue": unrounded_revenue,
    "warehouse_sql": warehouse_sql,
}
