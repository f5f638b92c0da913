"""One run: statement files in, an export and statistics of each out."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.prepare import BEFORE, STATEMENT, collate_keys
from tallymark.plans import mpos, pmc, transacciones
from tallymark.sinks.export import export_name, rejected_name, statistics_name, write_export, write_rejected, write_statistics
from tallymark.sinks.publish import outputs
from tallymark.sources import files as stored
from tallymark.sources import records
from tallymark.sources.layouts import MPOS, PMC, TRANSACCIONES, Layout, layout_for
from tallymark.sources.ledger import Ledger
from tallymark.sources.records import FILE
from tallymark.sources.scratch import run_scratch
from tallymark.sources.statement import Staged, stage

PLANS = {PMC.name: pmc, MPOS.name: mpos, TRANSACCIONES.name: transacciones}


def escaped(file: str) -> str:
    """A path whose name is taken as it is, brackets and stars included."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", file)


@dataclass(frozen=True)
class Run:
    """What a run found: the layout, how many lines were read, and how many records were not as the layout says."""

    layout: Layout
    lines: int
    rejected: int


def run(
    spark: SparkSession,
    file: str,
    ledger: Ledger,
    out: str,
    *,
    merchant_id: bool = False,
    keep_duplicates: bool = False,
    collation: str | None = None,
    compression: str | None = None,
    **read_options,
) -> Run | None:
    """Read, number, match and write one file. A name without a layout is left alone and gives None.

    The lines are written to the shared folder once, and so is the part of the ledger that they need; the export and the
    statistics both start from there. Records that are not as the layout says are listed beside the outputs, if there are any.
    Outputs appear together, when all of them are written, the export last and with a manifest; a run that fails leaves those of
    the run before as they are. Tables of the run in the shared folder are removed at its end.
    ``keep_duplicates`` is for the day-matched layout, ``collation`` compares codes by it, ``compression`` packs the export's
    parts. The name is a name, not a pattern.
    """
    name = file.rstrip("/").rsplit("/", 1)[-1]
    layout = layout_for(name)
    if layout is None:
        return None
    plan, out = PLANS[layout.name], out.rstrip("/")
    export = plan.export_merchant_id if merchant_id and hasattr(plan, "export_merchant_id") else plan.export
    options = {"keep_duplicates": True} if keep_duplicates and layout is TRANSACCIONES else {}
    names = export_name(name), statistics_name(name), rejected_name(name)
    with run_scratch(spark), outputs(spark, out) as written:
        staged = stage(spark, escaped(file), layout, **read_options)
        lines = staged.lines
        if collation:
            lines, ledger = collate_keys(lines, ledger, layout, collation)
        found = plan.reduced(lines, ledger, shared=True)
        write_export(export(lines, ledger, found, **options), written.path(names[0]), compression=compression)
        write_statistics(plan.statistics(lines, ledger, found), written.path(names[1]))
        if staged.rejected_count:
            write_rejected(staged.rejected, written.path(names[2]))
        done = Run(layout, found.profile.lines, staged.rejected_count)
        written.publish(names[0], names, {"file": file, "layout": layout.name, "lines": done.lines, "rejected": done.rejected})
    return done


def run_files(
    spark: SparkSession,
    files: Sequence[str],
    ledger: Ledger,
    out: str,
    *,
    merchant_id: bool = False,
    keep_duplicates: bool = False,
    collation: str | None = None,
    compression: str | None = None,
    **read_options,
) -> dict[str, Run | None]:
    """As :func:`run` for each of the files, but those of one layout are read, matched and written together.

    The ledger is read once for a layout, and the number of jobs does not grow with the files. Line numbers, duplicates and
    counts are those of each file by itself; outputs of a file are published together. Two files may not have one name, since
    their outputs would. Files without lines, and files in character sets whose lines cannot be cut, are run one by one.
    """
    names = {file: file.rstrip("/").rsplit("/", 1)[-1] for file in files}
    if len(set(names.values())) < len(names):
        raise ValueError("files of one name would have one output")
    done: dict[str, Run | None] = dict.fromkeys(names)
    each = {"merchant_id": merchant_id, "keep_duplicates": keep_duplicates, "collation": collation, "compression": compression, **read_options}
    for layout in {layout.name: layout for layout in map(layout_for, names.values()) if layout}.values():
        group = [file for file, name in names.items() if layout_for(name) is layout]
        cut = records.can_cut(read_options.get("charset", "ISO-8859-1"), read_options.get("quote", '"'), layout.delimiter)
        if len(group) > 1 and cut:
            done |= _run_together(spark, group, layout, ledger, out.rstrip("/"), **each)
        for file in group:
            done[file] = done[file] or run(spark, file, ledger, out, **each)
    return done


def _run_together(
    spark: SparkSession,
    group: list[str],
    layout: Layout,
    ledger: Ledger,
    out: str,
    *,
    merchant_id: bool,
    keep_duplicates: bool,
    collation: str | None,
    compression: str | None,
    **read_options,
) -> dict[str, Run]:
    """Runs of the files of one layout that have lines."""
    plan = PLANS[layout.name]
    export = plan.export_merchant_id if merchant_id and hasattr(plan, "export_merchant_id") else plan.export
    options = {"keep_duplicates": True} if keep_duplicates and layout is TRANSACCIONES else {}
    with run_scratch(spark), outputs(spark, out) as written:
        staged = stage(spark, [escaped(file) for file in group], layout, keep_file=True, **read_options)
        lines, rejected, counts = _of_statements(spark, staged, layout, group)
        if not counts:
            return {}
        if collation:
            lines, ledger = collate_keys(lines, ledger, layout, collation)
        found = plan.reduced(lines, ledger, shared=True)
        by = [STATEMENT]
        write_export(export(lines, ledger, found, **options), written.path("exports"), by=by, compression=compression)
        write_statistics(plan.statistics(lines, ledger, found), written.path("statistics"), by=by)
        lost = {}
        if staged.rejected_count:
            lost = {r[STATEMENT]: r["count"] for r in rejected.groupBy(*by).count().collect()}
            write_rejected(rejected, written.path("rejected"), by=by)
        names = {k: group[k].rstrip("/").rsplit("/", 1)[-1] for k in counts}
        for folder, output in (("exports", export_name), ("statistics", statistics_name), ("rejected", rejected_name)):
            written.parts(folder, STATEMENT, {k: output(name) for k, name in names.items()})
        done = {}
        for k, name in names.items():
            of = export_name(name), statistics_name(name), rejected_name(name)
            done[group[k]] = Run(layout, counts[k], lost.get(k, 0))
            written.publish(of[0], of, {"file": group[k], "layout": layout.name, "lines": counts[k], "rejected": lost.get(k, 0)})
    return done


def _of_statements(spark: SparkSession, staged: Staged, layout: Layout, group: list[str]) -> tuple[DataFrame, DataFrame, dict[int, int]]:
    """Lines and rejected records with the place of their statement in ``group``, and the lines that each statement has, if any.

    A statement may be a folder of files. Its lines are numbered one after the other, as the paths of its files are in order.
    """
    roots = {stored.qualified(spark, file): k for k, file in enumerate(group)}

    def statement(path: str) -> int:
        for told in (path, unquote(path)):
            while told:
                if told in roots:
                    return roots[told]
                told = told.rpartition("/")[0]
        raise ValueError(f"{path} is of none of the files")

    # One row for each file that was listed for reading.
    sizes = staged.lines.groupBy(FILE).agg(F.count("*").alias("lines"), F.min(layout.line_id).alias("first")).collect()
    rejects = [r["file"] for r in staged.rejected.select("file").distinct().collect()] if staged.rejected_count else []
    counts: dict[int, int] = {}
    before: dict[int, int] = {}
    for row in sizes:
        k = statement(row[FILE])
        counts[k] = counts.get(k, 0) + row["lines"]
        before[k] = min(before.get(k, row["first"] - 1), row["first"] - 1)
    known = [(path, statement(path)) for path in sorted({r[FILE] for r in sizes} | set(rejects))]
    of = spark.createDataFrame([(path, k, before[k]) for path, k in known if k in counts], f"{FILE} string, {STATEMENT} int, {BEFORE} long")
    few = len(known) * records.MAX_PATH_BYTES <= records.MERGED_BYTES
    of = F.broadcast(of) if few else of
    rejected = staged.rejected.join(of.withColumnRenamed(FILE, "file").drop(BEFORE), "file")
    return staged.lines.join(of, FILE).drop(FILE), rejected, counts


def reconcile(spark: SparkSession, file: str, ledger: Ledger, out: str, **options) -> Layout | None:
    """As :func:`run`, for the layout alone."""
    done = run(spark, file, ledger, out, **options)
    return done.layout if done else None
