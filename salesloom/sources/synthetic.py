"""Synthetic sales lines as column expressions over row ids.

Every draw is 32 bits of an md5 of the seed, the name of a set of draws and the row id, so a row is
the same however the ids are partitioned, whichever task computes it and in any engine that has md5.
The distributions are the contract.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions import customer_id
from salesloom.operators.keys import with_surrogate_key
from salesloom.schemas import RAW_SALES

# Ship modes, segments, and the cities with state, postal code prefix and region.
SHIP_MODES = ["First Class", "Second Class", "Standard Class"]
SEGMENTS = ["Consumer", "Corporate", "Home Office"]
CITIES = [
    ("New York", "New York", "100", "East"),
    ("Los Angeles", "California", "900", "West"),
    ("Chicago", "Illinois", "606", "Central"),
    ("Houston", "Texas", "770", "Central"),
    ("Phoenix", "Arizona", "850", "West"),
    ("Philadelphia", "Pennsylvania", "191", "East"),
    ("San Antonio", "Texas", "782", "Central"),
    ("San Diego", "California", "921", "West"),
    ("Dallas", "Texas", "752", "Central"),
    ("San Jose", "California", "951", "West"),
    ("Austin", "Texas", "787", "Central"),
    ("Jacksonville", "Florida", "322", "South"),
    ("Fort Worth", "Texas", "761", "Central"),
    ("Columbus", "Ohio", "432", "East"),
    ("Charlotte", "North Carolina", "282", "South"),
    ("Indianapolis", "Indiana", "462", "Central"),
    ("Seattle", "Washington", "981", "West"),
    ("Denver", "Colorado", "802", "West"),
    ("Boston", "Massachusetts", "021", "East"),
    ("Nashville", "Tennessee", "372", "South"),
    ("Detroit", "Michigan", "482", "Central"),
    ("Portland", "Oregon", "972", "West"),
    ("Las Vegas", "Nevada", "891", "West"),
    ("Miami", "Florida", "331", "South"),
    ("Atlanta", "Georgia", "303", "South"),
]

FIRST_NAMES = [
    "Ada", "Ben", "Cleo", "Dario", "Elin", "Femi", "Gita", "Hugo",
    "Iris", "Jonas", "Kaya", "Lena", "Milo", "Nora", "Otis", "Petra",
]
LAST_NAMES = [
    "Abara", "Berg", "Castell", "Dunn", "Ekman", "Ferro", "Grant", "Holm",
    "Ivers", "Jung", "Kovac", "Lund", "Moreau", "Novak",
]


# Sets of four draws, which share one md5.
DRAWS = {
    "product": ("category", "sub-category", "product", "quantity"),
    "order": ("order date", "ship date", "ship mode", "order"),
    "place": ("city", "postal code"),
    "customer": ("first name", "last name", "segment"),
}


def _draw(seed: int, name: str, key: Column, choices: int | Column) -> Column:
    """Uniform integer in [0, choices), up to 2^32 of them: 32 bits modulo the choices."""
    group, place = next((g, names.index(name)) for g, names in DRAWS.items() if name in names)
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(group), key.cast("string"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 8 * place + 1, 8), 16, 10).cast("bigint")
    bound = choices if isinstance(choices, Column) else F.lit(choices)
    return bits % bound.cast("bigint")


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*values), index.cast("int"))


def _pick_text(values: list[str], index: Column) -> Column:
    return _pick([F.lit(v) for v in values], index)


def customer_columns(index: Column, seed: int = 42) -> dict[str, Column]:
    """Customer ``index`` of a pool of any size.

    A pool of n customers is index 0..n-1, so a larger pool extends a smaller one. The number in
    the id is a permutation of the index, hence unique; past 90,000 customers it gets more digits.
    """
    first, last = FIRST_NAMES, LAST_NAMES
    name = F.concat_ws(
        " ",
        _pick_text(first, _draw(seed, "first name", index, len(first))),
        _pick_text(last, _draw(seed, "last name", index, len(last))),
    )
    block = F.floor(index / 90000)
    number = F.lit(10000) + F.pmod(index * 7919 + seed, F.lit(90000)) + block * 90000
    return {
        "customer_id": customer_id(name, number),
        "customer_name": name,
        "segment": _pick_text(SEGMENTS, _draw(seed, "segment", index, len(SEGMENTS))),
    }


def customer_pool(spark: SparkSession, size: int, seed: int = 42) -> DataFrame:
    columns = customer_columns(F.col("id"), seed)
    return spark.range(size).select(*[c.alias(name) for name, c in columns.items()])


@dataclass(frozen=True)
class IndexedCatalog:
    """The catalog as three levels of dense numbers; each row knows the range below it."""

    categories: DataFrame
    sub_categories: DataFrame
    products: DataFrame
    category_count: int


def index_catalog(catalog: DataFrame) -> IndexedCatalog:
    order = ["category", "sub_category", "product_id", "product_name", "price"]
    products = with_surrogate_key(
        catalog.select(*order), [F.asc_nulls_last(c) for c in order], "product_no"
    )
    sub_categories = with_surrogate_key(
        products.groupBy("category", "sub_category").agg(
            F.min("product_no").alias("first_product"), F.count("*").alias("product_count")
        ),
        [F.asc_nulls_last("category"), F.asc_nulls_last("sub_category")],
        "sub_category_no",
    )
    categories = with_surrogate_key(
        sub_categories.groupBy("category").agg(
            F.min("sub_category_no").alias("first_sub_category"),
            F.count("*").alias("sub_category_count"),
        ),
        [F.asc_nulls_last("category")],
        "category_no",
    )
    return IndexedCatalog(
        categories.drop("category"),
        sub_categories.drop("category", "sub_category"),
        products,
        categories.count(),
    )


def _with_product(rows: DataFrame, catalog: IndexedCatalog, seed: int) -> DataFrame:
    """Uniform category, then sub-category within it, then product within that."""
    key = F.col("row_id")

    def below(first: str, count: str, name: str) -> Column:
        return F.col(first) + _draw(seed, name, key, F.col(count))

    return (
        rows.withColumn("category_no", 1 + _draw(seed, "category", key, catalog.category_count))
        .join(catalog.categories, "category_no")
        .withColumn(
            "sub_category_no", below("first_sub_category", "sub_category_count", "sub-category")
        )
        .join(catalog.sub_categories, "sub_category_no")
        .withColumn("product_no", below("first_product", "product_count", "product"))
        .join(catalog.products, "product_no")
    )


def ship_mode(order_date: Column, ship_date: Column, choice: Column) -> Column:
    return F.when(order_date == ship_date, "Same Day").otherwise(_pick_text(SHIP_MODES, choice))


def quantity_limit(category: Column) -> Column:
    return F.when(category == "Furniture", 2).when(category == "Technology", 12).otherwise(50)


def discount_tier(quantity: Column) -> Column:
    return (
        F.when(quantity >= 100, 0.15)
        .when(quantity >= 20, 0.10)
        .when(quantity >= 5, 0.05)
        .otherwise(0.0)
    )


def synthesize(
    row_ids: DataFrame,
    catalog: DataFrame,
    start_date: date,
    end_date: date,
    num_customers: int = 100,
    seed: int = 42,
) -> DataFrame:
    """One raw sales line per ``row_id`` (from 1); customers take turns."""
    key = F.col("row_id")
    days = (end_date - start_date).days + 1
    place = _pick(
        [
            F.struct(
                F.lit(city).alias("city"),
                F.lit(state).alias("state"),
                F.lit(prefix).alias("prefix"),
                F.lit(region).alias("region"),
            )
            for city, state, prefix, region in CITIES
        ],
        _draw(seed, "city", key, len(CITIES)),
    )
    zip_tail = (10 + _draw(seed, "postal code", key, 90)).cast("string")
    order_number = (100000 + _draw(seed, "order", key, 900000)).cast("string")

    rows = row_ids.select(key.cast("bigint").alias("row_id"))
    rows = _with_product(rows, index_catalog(catalog), seed)
    rows = rows.withColumns(
        {
            "_customer": F.pmod(key - 1, F.lit(num_customers)),
            "_place": place,
            "order_date": F.date_add(
                F.lit(start_date), _draw(seed, "order date", key, days).cast("int")
            ),
            "quantity": (
                1 + _draw(seed, "quantity", key, quantity_limit(F.col("category")))
            ).cast("int"),
        }
    ).withColumn(
        "ship_date",
        F.date_add("order_date", (1 + _draw(seed, "ship date", key, 7)).cast("int")),
    )
    columns = customer_columns(F.col("_customer"), seed) | {
        "order_id": F.concat_ws(
            "-", F.lit("US"), F.year("order_date").cast("string"), order_number
        ),
        "ship_mode": ship_mode(
            F.col("order_date"),
            F.col("ship_date"),
            _draw(seed, "ship mode", key, len(SHIP_MODES)),
        ),
        "city": F.col("_place.city"),
        "state": F.col("_place.state"),
        "postal_code": F.concat(F.col("_place.prefix"), zip_tail),
        "region": F.col("_place.region"),
        "discount": discount_tier(F.col("quantity")),
    }
    return rows.select(
        *[columns.get(c, F.col(c)).alias(c) for c in RAW_SALES.fieldNames()]
    )


def synthetic_sales(
    spark: SparkSession,
    num_rows: int,
    catalog: DataFrame,
    start_date: date,
    end_date: date,
    num_customers: int = 100,
    seed: int = 42,
    rows_per_task: int = 2_000_000,
) -> DataFrame:
    """Lines 1 to ``num_rows``, made by as many tasks as ``rows_per_task`` asks for."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-num_rows // rows_per_task))
    ids = spark.range(1, num_rows + 1, numPartitions=tasks).withColumnRenamed("id", "row_id")
    return synthesize(ids, catalog, start_date, end_date, num_customers, seed)
