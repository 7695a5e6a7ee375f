"""spark-submit script: CSV leads in, clean, rejected and CRM leads and a summary out.

    spark-submit --py-files leadmill.zip submit_job.py --output OUT INPUT [INPUT ...]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from leadmill.plans import run_job
from leadmill.session import SETTINGS
from leadmill.sources.countries import load_countries
from leadmill.sources.rules import load_scoring_rules


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("input", nargs="+")
    parser.add_argument("--output", required=True)
    parser.add_argument("--run", help="name of the run; given again after a failure, the job goes on where it ended")
    parser.add_argument("--rules", help="JSON file of scoring rules")
    parser.add_argument("--countries", help="JSON file of countries")
    parser.add_argument("--country-table", help="JSON files of very many countries, one a line")
    parser.add_argument("--multiline", action="store_true",
                        help="cells may hold line breaks; each file is then one task")
    parser.add_argument("--split-multiline", action="store_true",
                        help="cells may hold line breaks, and files are split all the same")
    parser.add_argument("--reject-malformed", action="store_true",
                        help="reject malformed CSV rows instead of failing")
    parser.add_argument("--all-leads", action="store_true", help="export leads that are not ready, too")
    parser.add_argument("--csv-copies", action="store_true")
    parser.add_argument("--overwrite", action="store_true")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("prepare-leads").config(map=SETTINGS).getOrCreate()
    run_job(
        spark,
        args.input,
        args.output,
        run=args.run,
        multiline="split" if args.split_multiline else args.multiline,
        malformed="reject" if args.reject_malformed else "fail",
        rules=load_scoring_rules(args.rules) if args.rules else None,
        countries=load_countries(args.countries) if args.countries else args.country_table,
        ready_only=not args.all_leads,
        csv_copies=args.csv_copies,
        mode="overwrite" if args.overwrite else "errorifexists",
    )
    spark.stop()


if __name__ == "__main__":
    main()
