"""Run the batch job: ``spark-submit jobs/batch_job.py CATALOG FOLDER [option ...]``."""

import argparse
import logging
import os
import sys
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesloom import scratch  # noqa: E402
from salesloom.plans.batch import BatchResult, run_batch  # noqa: E402
from salesloom.session import build_session  # noqa: E402

REFUSED, NO_STAR = 2, 3


def options() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        description="Make, clean, sum up, check and store sales lines.",
        epilog=f"Exit code {REFUSED}: refused input; {NO_STAR}: all stored but the star schema.",
    )
    parser.add_argument("catalog", help="JSON file with the products")
    parser.add_argument("folder", help="where everything is stored")
    parser.add_argument("-n", "--lines", type=int, default=100_000, help="lines to make")
    parser.add_argument("--buyers", type=int, default=100, help="customers they are spread over")
    parser.add_argument(
        "--between",
        nargs=2,
        type=date.fromisoformat,
        metavar="DAY",
        default=[date(2024, 1, 1), date(2024, 12, 31)],
        help="first and last order date",
    )
    parser.add_argument("--keep-lines", action="store_true", help="take stored lines if complete")
    parser.add_argument("--no-star", action="store_true", help="leave the star schema out")
    return parser


def run(args: argparse.Namespace) -> BatchResult:
    spark = build_session("sales-batch")
    try:
        return run_batch(
            spark,
            args.catalog,
            args.folder,
            args.lines,
            *args.between,
            rebuild=not args.keep_lines,
            build_star_schema=not args.no_star,
            num_customers=args.buyers,
        )
    finally:
        scratch.clear(spark)
        spark.stop()


def main() -> int:
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    try:
        result = run(options().parse_args())
    except ValueError as error:
        logging.error("Refused: %s", error)
        return REFUSED
    logging.info("Checks: %s", result.quality)
    return NO_STAR if result.star_error else 0


if __name__ == "__main__":
    sys.exit(main())
