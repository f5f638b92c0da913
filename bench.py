"""Time the pipelines on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]`` and print one JSON line.

``queries`` holds the best of ``$BENCH_RUNS`` runs after a first one, whose times, with code generation and plan
set-up in them, are in ``first_run``. ``stage_trx`` runs once. Every row and column is computed each time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from tallymark.session import SETTINGS
from tallymark.workload import bindings
from tallymark.workload.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))  # timed runs after the first; the best counts
HEADLINE = [
    "load_statement_pmc",
    "load_statement_mpos",
    "load_statement_transacciones",
    "export_pmc",
    "stats_pmc",
    "export_pmc_merchant_id",
    "export_mpos",
    "stats_mpos_grouped",
    "export_trx",
    "stats_trx",
    "export_trx_merchant_id",
    "match_key_date",
    "lookup_chain",
]


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("tallymark-bench")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    """Compute every row and column without a sink."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session()
    run(bindings.table(spark, SF_DIR, "lineitem"))  # start executors and the code generator
    seconds: dict[str, float] = {}
    first: dict[str, float] = {}

    def timed(work) -> float:
        start = time.perf_counter()
        work()
        return round(time.perf_counter() - start, 3)

    # Numbering the day-matched statement is a step of its own: export and statistics read its result.
    seconds["stage_trx"] = timed(lambda: bindings.numbered_lineitem(spark, SF_DIR).count())
    for name in sys.argv[1:] or HEADLINE:
        first[name] = timed(lambda: run(QUERIES[name](spark, SF_DIR)))
        seconds[name] = min(timed(lambda: run(QUERIES[name](spark, SF_DIR))) for _ in range(RUNS))
    print(
        json.dumps(
            {
                "metric": "pipelines_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "first_run": first,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
