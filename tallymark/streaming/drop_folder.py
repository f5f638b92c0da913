"""Run the pipelines once for every statement that arrives in a folder."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymark.plans.run import reconcile, run_files
from tallymark.sources.ledger import Ledger
from tallymark.sources.statement import UNKNOWN_LAYOUT, BrokenStatement, route_layout

# Spark's names of errors that a file has by itself and will have again.
FILE_ERRORS = ("PATH_NOT_FOUND", "FAILED_READ_FILE", "MALFORMED_CSV_RECORD", "MALFORMED_RECORD_IN_PARSING")


def unreadable(error: Exception) -> bool:
    """The statement is to blame: it is refused, gone or not readable."""
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    return isinstance(error, BrokenStatement) or (condition or "").startswith(FILE_ERRORS)


def reconcile_arrivals(
    spark: SparkSession,
    folder: str,
    ledger: Ledger,
    out: str,
    checkpoint: str,
    *,
    files_per_batch: int = 100,
    **run_options,
) -> StreamingQuery:
    """Reconcile the files that are new since the last call, then stop.

    The stream carries names only, at most ``files_per_batch`` at a time; the files of a batch are read by one run, on
    the whole cluster, and one by one if that fails. Outputs are named after the file and overwritten, so a batch that is repeated changes nothing.
    A file that cannot be read is recorded in ``FAILED_<batch>`` beside the outputs, and the others go on. Any other error is no
    fault of the file: the others go on too, then the query ends with the error, and the next call repeats the batch.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select("path")
        .filter(route_layout(F.element_at(F.split("path", "/"), -1)) != UNKNOWN_LAYOUT)
    )

    def run(batch: DataFrame, batch_id: int) -> None:
        failed, again, paths = [], [], [row["path"] for row in batch.toLocalIterator()]
        try:
            run_files(spark, paths, ledger, out, **run_options)
            return
        except Exception:  # noqa: BLE001  which file it was, if any, is found out below
            pass
        for path in paths:
            try:
                reconcile(spark, path, ledger, out, **run_options)
            except Exception as error:  # noqa: BLE001  one bad file must not keep all others waiting
                if unreadable(error):
                    failed.append((path, type(error).__name__, str(error)[:1000]))
                else:
                    again.append(error)
        if failed:
            schema = "path string, error string, message string"
            spark.createDataFrame(failed, schema).coalesce(1).write.mode("overwrite").json(f"{out.rstrip('/')}/FAILED_{batch_id}")
        if again:
            raise again[0]

    return names.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
