"""Run the whole job on a folder of raw text files.

    spark-submit --py-files ... -m ledgerloom RAW_FOLDER OUTPUT_FOLDER [--csv]

RAW_FOLDER holds the ten raw tables and `dim_date.csv`. OUTPUT_FOLDER receives the
run; with --csv also `clean` and `quarantine` as text. Lines that are no row of their table
go to `malformed`. Partition counts follow the size of RAW_FOLDER. Prints the figures of the run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerloom.operators.star import accepted, apply_schema
from ledgerloom.plans import pipeline
from ledgerloom.rules import Rules
from ledgerloom.schemas import RAW_TABLES, STAR
from ledgerloom.session import build_session, input_bytes, settings_for
from ledgerloom.sources import published as pub
from ledgerloom.sources.raw import malformed_lines, scan_raw, scan_text


def run_folder(
    spark: SparkSession, raw_folder: str, out_folder: str, rules: Rules, csv: bool = False
) -> pipeline.Published:
    for key, value in settings_for(input_bytes(spark, raw_folder)).items():
        spark.conf.set(key, value)
    calendar = accepted(
        apply_schema(scan_text(spark, f"{raw_folder}/dim_date.csv"), STAR["dim_date"])
    )
    malformed_lines(spark, raw_folder).write.mode("overwrite").parquet(f"{out_folder}/malformed")
    raw = scan_raw(spark, raw_folder, skip_malformed=True)
    out = pipeline.run(raw, calendar, rules, out_folder)
    if csv:
        tables = {name: out.clean(name) for name in RAW_TABLES}
        pub.publish_clean(tables, f"{out_folder}/clean", form="csv")
        pub.publish_quarantine(out.quarantine(), f"{out_folder}/quarantine", form="csv")
    return out


def main() -> None:
    parser = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    parser.add_argument("raw_folder")
    parser.add_argument("out_folder")
    parser.add_argument("--csv", action="store_true")
    given = parser.parse_args()
    spark = build_session("ledgerloom")
    out = run_folder(spark, given.raw_folder, given.out_folder, Rules(), given.csv)
    out.run_summary().show(50, truncate=False)
    out.corrections().show(50, truncate=False)
    out.quarantine_reasons().show(truncate=False)
    print("settlements that drift:", out.settlement_drift().count())
    print("headcounts that drift:", out.headcount_drift().count())
    print("rows with refused values:", out.refused().count())
    print("malformed lines:", spark.read.parquet(f"{given.out_folder}/malformed").count())


if __name__ == "__main__":
    main()
