"""The batch job: extract, clean, enrich, summarize, check, store, load, star schema."""

import logging
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import versions
from salesloom.operators import star as star_schema
from salesloom.operators.clean import clean, with_amounts, with_order_period
from salesloom.operators.quality import quality_report, quality_results
from salesloom.operators.star import Star
from salesloom.operators.summaries import build_summaries
from salesloom.schemas import AMOUNTS, RAW_SALES, SALES, SUMMARIES
from salesloom.sinks import files, warehouse
from salesloom.sources.catalog import read_catalog
from salesloom.sources.files import read_sales, read_summary
from salesloom.sources.synthetic import synthetic_sales

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BatchResult:
    """Stored tables as lazy frames, and the verdicts. ``star_error`` says why there is no star, and
    ``refused`` holds the keys that repeat, if that is why. ``reports`` is the folder of the run's
    sample, summaries and report."""

    sales: DataFrame
    summaries: dict[str, DataFrame]
    quality: dict[str, bool]
    reports: str
    star: Star | None = None
    star_error: str | None = None
    refused: DataFrame | None = None


class StarRefused(ValueError):
    """The lines' keys repeat, so there is no star of them. ``verdict`` is a stored table of the
    natural keys that do, see :func:`salesloom.operators.star.repeated_natural_keys`."""

    def __init__(self, message: str, verdict: DataFrame) -> None:
        super().__init__(message)
        self.verdict = verdict


def check_arguments(num_rows: int, start_date: date, end_date: date) -> None:
    if num_rows < 1:
        raise ValueError("num_synthetic_rows must be >= 1")
    if start_date > end_date:
        raise ValueError("start_date must be <= end_date")


def build_dataset(
    spark: SparkSession,
    catalog_path: str,
    bronze: str,
    num_rows: int,
    start_date: date,
    end_date: date,
    rebuild: bool = True,
    num_customers: int = 100,
    seed: int = 42,
    catalog_lines: bool = False,
) -> DataFrame:
    """Stored raw lines; synthesized first if ``rebuild`` or if no finished ones exist."""
    if not rebuild:
        try:
            return read_sales(spark, bronze, RAW_SALES)
        except FileNotFoundError:
            log.info("No finished dataset at %s", bronze)
    catalog = read_catalog(spark, catalog_path, catalog_lines)
    raw = synthetic_sales(spark, num_rows, catalog, start_date, end_date, num_customers, seed)
    files.write_bronze(raw, bronze)
    return read_sales(spark, bronze, RAW_SALES)


def load_star(
    spark: SparkSession,
    sales: DataFrame,
    version: str,
    database: str,
    finish: star_schema.Finish | None = None,
) -> Star:
    """Build the star, check its keys and only then write it to the new folder ``version``.

    ``finish`` makes the amounts of ``sales`` anew after the fact's joins, so that they are not
    shuffled; it is for lines whose amounts it has made.

    Repeated keys raise :class:`StarRefused`; what is wrong is then stored beside, as
    ``<version>_refused``.
    """
    if finish is not None:
        sales = sales.drop(*(f.name for f in AMOUNTS))
    star = star_schema.build_star(sales, finish)
    # Eight rows, one per checked key.
    faulty = star_schema.key_problems(star).where(
        "duplicate_keys > 0 OR (null_rows > 0 AND key_columns = 'row_id')"
    )
    problems = [
        f"{row.table_name} ({row.key_columns}): {row.duplicate_keys} repeated keys, "
        f"{row.null_rows} rows without key"
        for row in faulty.collect()
    ]
    if problems:
        refused = f"{version}_refused"
        verdict = star_schema.repeated_natural_keys(star)
        verdict.write.parquet(refused)
        raise StarRefused("; ".join(problems), spark.read.schema(verdict.schema).parquet(refused))
    warehouse.save_star(star, version, database)
    return warehouse.read_star(spark, database)


def run_batch(
    spark: SparkSession,
    catalog_path: str,
    output_dir: str,
    num_synthetic_rows: int = 100_000,
    start_date: date = date(2024, 1, 1),
    end_date: date = date(2024, 12, 31),
    rebuild: bool = True,
    build_star_schema: bool = True,
    num_customers: int = 100,
    seed: int = 42,
    database: str = warehouse.DATABASE,
    catalog_lines: bool = False,
) -> BatchResult:
    """Run all stages. Neither failed checks nor a failed star build stop the job.

    ``catalog_lines`` says that each line of the catalog is a document of its own.

    A star belongs to the lines it was made of: when these are stored anew, the earlier star is no
    longer served, whether or not a new one follows.
    """
    check_arguments(num_synthetic_rows, start_date, end_date)
    raw = build_dataset(
        spark,
        catalog_path,
        f"{output_dir}/bronze",
        num_synthetic_rows,
        start_date,
        end_date,
        rebuild,
        num_customers,
        seed,
        catalog_lines,
    )

    # Everything downstream reads the stored lines, so cleaning and enrichment run once.
    silver = f"{output_dir}/silver"
    written = files.write_silver(with_order_period(clean(raw)), silver, with_amounts)
    sales = read_sales(spark, written)

    summaries = build_summaries(sales)
    quality = quality_results(quality_report(sales))
    with files.report_set(spark, f"{output_dir}/reports", {"silver": written}) as reports:
        files.write_sample(sales, f"{reports}/sample_data.csv")
        files.write_summaries(summaries, reports)
        files.write_quality(quality_frame(spark, quality), f"{reports}/quality_report.json")

    warehouse.create_database(spark, database)
    warehouse.register_sales(spark, silver, database)
    warehouse.drop_star(spark, database)
    star, star_error, refused = None, None, None
    if build_star_schema:
        try:
            stored = warehouse.read_table(spark, "sales", database)
            star = load_star(spark, stored, star_version(output_dir, written), database, with_amounts)
            versions.prune(spark, f"{output_dir}/warehouse")
        except Exception as error:
            # Whatever went wrong with the star, the stored sales stay usable.
            star_error, refused = str(error), getattr(error, "verdict", None)
            log.error("Failed to build the star schema: %s", error)
    return BatchResult(sales, summaries, quality, reports, star, star_error, refused)


def read_reports(spark: SparkSession, output_dir: str) -> dict[str, DataFrame] | None:
    """Sample, summaries, quality report and sales of one run: the last that finished all of them."""
    manifest = files.read_manifest(spark, f"{output_dir}/reports")
    if manifest is None:
        return None
    folder = manifest["folder"]
    out = {"sales": read_sales(spark, manifest["silver"])}
    out["sample_data"] = spark.read.schema(SALES).option("header", True).csv(f"{folder}/sample_data.csv")
    for name in manifest["files"]:
        if name.removesuffix(".csv") in SUMMARIES:
            out[name.removesuffix(".csv")] = read_summary(spark, f"{folder}/{name}", SUMMARIES[name.removesuffix(".csv")])
    verdicts = spark.read.text(f"{folder}/quality_report.json")
    checks = F.explode(F.from_json("value", "map<string,boolean>")).alias("check_name", "passed")
    out["quality_report"] = verdicts.select(checks)
    return out


def star_version(output_dir: str, silver: str) -> str:
    """Folder of the star made of a version of silver: both have one name."""
    return f"{output_dir}/warehouse/{versions.name_of(silver)}"


def attach(
    spark: SparkSession, output_dir: str, database: str = warehouse.DATABASE
) -> dict[str, DataFrame]:
    """Tables that an earlier session stored, ready for SQL in this one."""
    warehouse.create_database(spark, database)
    warehouse.register_sales(spark, f"{output_dir}/silver", database)
    silver = versions.current(spark, f"{output_dir}/silver")
    warehouse.attach_star(spark, star_version(output_dir, silver), database)
    tables = sorted(table.name for table in spark.catalog.listTables(database))
    return {name: warehouse.read_table(spark, name, database) for name in tables}


def quality_frame(spark: SparkSession, results: dict[str, bool]) -> DataFrame:
    """The verdicts as rows again, to store them without a second scan."""
    return spark.createDataFrame(list(results.items()), "check_name string, passed boolean")


def validate(star: Star) -> dict[str, DataFrame]:
    """Reports on a stored star: sizes, key coverage, ship dates outside the calendar."""
    gap = star_schema.ship_date_gap(star.fact_sales, star.dim_date)
    return {
        "row_counts": star_schema.row_counts(star),
        "foreign_key_coverage": star_schema.foreign_key_coverage(star.fact_sales),
        "ship_date_gap": gap.agg(F.coalesce(F.sum("line_count"), F.lit(0)).alias("line_count")),
    }
