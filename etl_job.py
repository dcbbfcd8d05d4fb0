"""Run the whole batch: ``spark-submit etl_job.py SRC DST [--as-of 2024-03-01]``.

``SRC`` is a folder with the six CSV files and ``DST`` the folder for the 14 datasets; on
a cluster both must be shared by all executors.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from reelmetrics.plans.star_etl import run_from_csv


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("src")
    parser.add_argument("dst")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="the day that counts as today")
    parser.add_argument("--genres-per-user", type=int, default=5)
    parser.add_argument("--persist", action="store_true", help="cache the shared rollups")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("reelmetrics-etl").getOrCreate()
    rows, accounts = run_from_csv(spark, args.src, args.dst, args.as_of, args.genres_per_user, args.persist)
    for table, lines in accounts.items():
        print(f"{table}: {', '.join(f'{name} {n}' for name, n in lines._asdict().items() if n is not None)} lines")
    for name, n in rows.items():
        print(f"{name}: {n} rows")
    spark.stop()


if __name__ == "__main__":
    main()
