"""``python -m salesmart IN_DIR OUT_DIR``: run the batch; ``validate OUT_DIR`` checks its tables."""

from __future__ import annotations

import argparse
import logging

from salesmart.plans.batch import run, validate
from salesmart.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="salesmart", description=run.__doc__.splitlines()[0])
    parser.add_argument("in_dir", help="directory or URI of the delimited files, or: validate")
    parser.add_argument("out_dir", help="directory or URI for the stored tables")
    parser.add_argument("--quarantine", action="store_true")
    parser.add_argument("--empty-as-null", action="store_true")
    parser.add_argument("--sku-by-date", action="store_true")
    parser.add_argument("--fill-chain-name", action="store_true")
    parser.add_argument("--marts-by-month", action="store_true")
    parser.add_argument("--months", nargs="+", help="only these months of the daily marts, as 2025-01")
    parser.add_argument("--normalise", choices=("month", "week"), default="month")
    parser.add_argument("--plan-storage", choices=("double", "float"), default="float")
    parser.add_argument("--report-only", action="store_true", help="do not fail on checks")
    options = vars(parser.parse_args())
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session()
    try:
        if options["in_dir"] == "validate":
            tolerated = ["negative_stock", *(["old_sku"] if options["sku_by_date"] else [])]
            validate(
                spark, options["out_dir"], tolerated=tolerated, fail_on_checks=not options["report_only"]
            )
            return
        run(
            spark,
            options.pop("in_dir"),
            options.pop("out_dir"),
            fail_on_checks=not options.pop("report_only"),
            **options,
        )
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
