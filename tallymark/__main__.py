"""Reconcile statement files from the command line: ``python -m tallymark --ledger DIR --out DIR FILE...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tallymark.plans.run import run_files
from tallymark.session import build_session
from tallymark.sources.ledger import Ledger


def jdbc_settings(spark: SparkSession) -> dict[str, str]:
    """Connection options from the session's configuration, where spark-submit puts them; none is on the command line."""
    prefix = "spark.tallymark.jdbc."
    return {k.removeprefix(prefix): v for k, v in spark.sparkContext.getConf().getAll() if k.startswith(prefix)}


def main() -> None:
    parser = argparse.ArgumentParser(prog="tallymark", description="Match settlement statements with a payment ledger.")
    parser.add_argument("files", nargs="+", help="statement files; the name decides the layout")
    parser.add_argument("--ledger", required=True, help="folder with one parquet table per ledger table; with --jdbc the schema")
    parser.add_argument("--out", required=True, help="folder for exports and statistics")
    parser.add_argument("--merchant-id", action="store_true", help="export the merchant's id (version 4)")
    parser.add_argument("--jdbc", action="store_true", help="read the ledger over JDBC; url, user, password and driver are spark.tallymark.jdbc.*")
    parser.add_argument("--keep-duplicates", action="store_true", help="keep matched lines that repeat a code and id")
    parser.add_argument("--collation", help="compare codes by a collation, such as UTF8_LCASE_RTRIM")
    parser.add_argument("--compression", choices=["gzip"], help="pack the parts of exports")
    parser.add_argument("--charset", default="ISO-8859-1")
    parser.add_argument("--escape", default="\\", help="character that escapes a quote; a quote for doubled ones")
    parser.add_argument("--null", action="append", help="a word that stands for NULL; may be repeated")
    parser.add_argument("--multi-line", action="store_true", help="with --strict, values may hold line ends")
    parser.add_argument("--strict", action="store_true", help="refuse a file with an open quote at a line's end")
    args = parser.parse_args()
    spark = build_session()
    if args.jdbc:
        ledger = Ledger.from_jdbc(spark, jdbc_settings(spark), schema=args.ledger)
    else:
        ledger = Ledger.from_parquet(spark, args.ledger)
    options = {
        "merchant_id": args.merchant_id,
        "keep_duplicates": args.keep_duplicates,
        "collation": args.collation,
        "compression": args.compression,
        "charset": args.charset,
        "escape": args.escape,
        "null_tokens": tuple(args.null or ("\\N",)),
        "multi_line": args.multi_line,
        "strict": args.strict,
    }
    for file, done in run_files(spark, args.files, ledger, args.out, **options).items():
        print(f"{file}: {done.layout.name}, {done.lines} lines, {done.rejected} rejected" if done else f"{file}: no layout for this name, skipped")


if __name__ == "__main__":
    main()
