"""Column contracts of the raw table, the enriched table and the summaries."""

from pyspark.sql import types as T

RAW_SALES = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("ship_date", T.DateType()),
        T.StructField("ship_mode", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        # A string: some prefixes start with 0.
        T.StructField("postal_code", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("sub_category", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("discount", T.DoubleType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("order_year", T.IntegerType()),
        T.StructField("order_month", T.IntegerType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("discount_amount", T.DoubleType()),
        T.StructField("gross_sales", T.DoubleType()),
    ]
)

AMOUNTS = METRICS.fields[2:]

SALES = T.StructType(RAW_SALES.fields + METRICS.fields)

SUMMARIES = {
    "yearly": T.StructType(
        [
            T.StructField("order_year", T.IntegerType()),
            T.StructField("total_orders", T.LongType()),
            T.StructField("total_revenue", T.DoubleType()),
            T.StructField("unique_customers", T.LongType()),
        ]
    ),
    "regional_revenue": T.StructType(
        [
            T.StructField("region", T.StringType()),
            T.StructField("total_revenue", T.DoubleType()),
            T.StructField("total_orders", T.LongType()),
            T.StructField("unique_customers", T.LongType()),
        ]
    ),
    "top_products": T.StructType(
        [
            T.StructField("category", T.StringType()),
            T.StructField("product_name", T.StringType()),
            T.StructField("total_revenue", T.DoubleType()),
        ]
    ),
}

CATALOG_JSON = "map<string,map<string,array<struct<name:string,price:double,product_id:string>>>>"

# Surrogate keys are bigint: a dimension or the fact may outgrow a 32-bit key.
STAR = {
    "dim_customer": "customer_key bigint, customer_id string, customer_name string, segment string",
    "dim_product": "product_key bigint, product_id string, product_name string, category string, "
    "sub_category string, base_price double",
    "dim_location": "location_key bigint, city string, state string, postal_code string, region string",
    "dim_date": "date_key int, date date, year int, month int, month_name string",
    "fact_sales": "sales_key bigint, order_id string, customer_key bigint, product_key bigint, "
    "location_key bigint, order_date_key int, ship_date_key int, ship_mode string, "
    "sales_amount double, quantity int, discount double, discount_amount double, "
    "gross_sales double, unit_price double, ship_latency_days int",
}
