"""Every registered query: an operator or a pipeline over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.columns import format_line, text_date
from tallymark.operators import lookup, match, prepare
from tallymark.operators.reduce import Reduced
from tallymark.plans import common, mpos, pmc, transacciones
from tallymark.plans.run import reconcile
from tallymark.sinks.export import PACKING, export_name, statistics_name
from tallymark.sources.layouts import MPOS, PMC, TRANSACCIONES, Layout
from tallymark.sources.scratch import scratch_path, shuffles_removed
from tallymark.sources.statement import route_layout, stage, stage_statement
from tallymark.workload import bindings as b

PACKED = "gzip"  # texts of statements and exports, which take five to eight times the disk as they are
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FILE_NAME = """select event_id, concat(case event_type when 'error' then 'x_pmc_MPOS_' when 'click' then 'Mpos-transacciones-'
    when 'view' then 'transacciones_' when 'signup' then 'PMC.' else 'foo_' end, cast(event_id as string), '.csv')
    as file_name from {events}"""
KEYS = """select event_id as id, case event_type when 'error' then '' when 'view' then cast(null as string)
    else cast(event_id * 2 as string) end as nro_orden from {events}"""
NULLED = """select case when event_type = 'error' then cast(null as bigint) else event_id end as id,
    cast(event_id * 2 as string) as nro_orden from {events}"""
DAY_TEXTS = """select l_orderkey, l_linenumber, case when l_returnflag = 'R' then concat('n/a ', l_linestatus)
    when l_returnflag = 'N' and l_linestatus = 'O' then '1999-02-30 00:00:00' else cast(l_shipdate as string) end
    as trx_date from {lineitem}"""


def query(f: Query) -> Query:
    """Register a query under its name; a trailing underscore only avoids a clash with an import."""
    QUERIES[f.__name__.rstrip("_")] = f
    return f


def _pmc_lines(spark: SparkSession, sf_dir: str, select: str = b.PMC_LINES) -> DataFrame:
    return prepare.drop_empty_key(b.bind(spark, sf_dir, select), PMC.key)


# Sources and preparation


@query
def route_layout_(spark, sf_dir):
    names = b.bind(spark, sf_dir, FILE_NAME)
    return names.select("event_id", "file_name", route_layout(F.col("file_name")).alias("layout"))


def _write(spark: SparkSession, rows: DataFrame, layout: Layout) -> str:
    """Write a statement, whose rows are in order, in the layout's file format and in several packed files; its folder."""
    path = scratch_path(spark, f"statement-{layout.name}")
    writer = (
        rows.select(*layout.columns)
        .write.option("header", True)
        .option("sep", layout.delimiter)
        .option("encoding", "ISO-8859-1")
        .option("nullValue", "\\N")
        .option("escape", "\\")
        .options(compression=PACKED, **PACKING)
    )
    with shuffles_removed(spark):
        writer.csv(path)
    return path


def _write_and_load(spark: SparkSession, rows: DataFrame, layout: Layout) -> DataFrame:
    return stage_statement(spark, _write(spark, rows, layout), layout)


@query
def load_statement_pmc(spark, sf_dir):
    return _write_and_load(spark, b.bind(spark, sf_dir, b.PMC_LINES, ["event_id"]), PMC)


@query
def load_statement_mpos(spark, sf_dir):
    return _write_and_load(spark, b.bind(spark, sf_dir, b.MPOS_LINES, ["event_id"]), MPOS)


@query
def load_statement_transacciones(spark, sf_dir):
    return _write_and_load(spark, b.ordered_lineitem(spark, sf_dir), TRANSACCIONES)


def _write_odd(spark: SparkSession, rows: DataFrame, layout: Layout) -> str:
    """As :func:`_write`, line by line: some lines have a field too many, and some a blank line behind them."""
    path = scratch_path(spark, f"odd-{layout.name}")
    options = {"sep": layout.delimiter, "nullValue": "\\N", "escape": "\\"}
    surplus = F.when(F.expr(b.SURPLUS_IN.format(id="id")), F.lit(f"{layout.delimiter}surplus")).otherwise(F.lit(""))
    blank = F.when(F.expr(b.BLANK_BEHIND.format(id="id")), F.lit("\n")).otherwise(F.lit(""))
    line = F.concat(F.to_csv(F.struct(*layout.columns), options), surplus, blank)
    # The first row of each file stands behind the file's header.
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    text = F.concat(F.when(first, F.lit(layout.delimiter.join(layout.columns) + "\n")).otherwise(F.lit("")), "line")
    with shuffles_removed(spark):
        rows.select(line.alias("line")).select(F.encode(text, "ISO-8859-1").cast("string").alias("value")).write.text(path)
    return path


@query
def load_odd_pmc(spark, sf_dir):
    rows = b.bind(spark, sf_dir, b.PMC_ODD_LINES, ["event_id"])
    return stage_statement(spark, _write_odd(spark, rows, PMC), PMC)


@query
def load_odd_mpos(spark, sf_dir):
    rows = b.bind(spark, sf_dir, b.MPOS_ODD_LINES, ["event_id"])
    return stage_statement(spark, _write_odd(spark, rows, MPOS), MPOS)


@query
def rejected_records(spark, sf_dir):
    """Records with another number of fields than their layout has; where they are in their files depends on how these were written."""
    staged = stage(spark, _write_odd(spark, b.bind(spark, sf_dir, b.MPOS_ODD_LINES, ["event_id"]), MPOS), MPOS)
    return staged.rejected.select("reason", "loaded", F.element_at(F.split("record", ","), -1).alias("last_field"), F.substring_index("record", ",", 1).alias("RUC"))


@query
def drop_empty_key(spark, sf_dir):
    return prepare.drop_empty_key(b.bind(spark, sf_dir, KEYS), PMC.key)


@query
def nonempty_key(spark, sf_dir):
    return b.bind(spark, sf_dir, KEYS).filter(prepare.nonempty(PMC.key))


@query
def assign_row_id(spark, sf_dir):
    keyed = prepare.drop_empty_key(b.bind(spark, sf_dir, KEYS), PMC.key).withColumnRenamed("id", "event_id")
    return prepare.assign_row_id(keyed, PMC.line_id, order_by=["event_id"])


# Matching

MATCH = ["_authorization_id", "codigo_referencia", "ref_id", "codigo_unico_adq", "monto_autorizado"]


def _match_or_null(lines: DataFrame, authorizations: DataFrame, all_codes: DataFrame, layout: Layout) -> DataFrame:
    matched = match.match_lines(lines, authorizations, layout).select(layout.line_id, layout.key, *MATCH)
    others = match.unmatched_lines(lines, all_codes, layout).select(layout.line_id, layout.key)
    rows = matched.unionByName(others, allowMissingColumns=True)
    return rows.withColumnRenamed("_authorization_id", "autorizacion_id").withColumn(
        "monto_autorizado", F.col("monto_autorizado").cast("string")
    )


@query
def match_reference(spark, sf_dir):
    a = b.ledger(spark, sf_dir, PMC).autorizacion
    return _match_or_null(_pmc_lines(spark, sf_dir), a, a, PMC)


@query
def match_acquirer_code(spark, sf_dir):
    a = b.ledger(spark, sf_dir, MPOS).autorizacion
    return _match_or_null(b.bind(spark, sf_dir, b.MPOS_LINES), a, a, MPOS)


def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = b.ledger(spark, sf_dir, TRANSACCIONES)
    return lookup.eligible_authorizations(ledger.autorizacion, ledger)


@query
def match_key_date(spark, sf_dir):
    eligible = _eligible(spark, sf_dir)
    eligible = eligible.withColumnRenamed("id", "autorizacion_id")
    lines = b.numbered_lineitem(spark, sf_dir).filter(prepare.nonempty(TRANSACCIONES.key))
    return lines.join(eligible, match.same_code_and_day(TRANSACCIONES)).select(
        F.col(TRANSACCIONES.line_id).alias("line_id"),
        TRANSACCIONES.key,
        "trx_date",
        "autorizacion_id",
        "ref_id",
        F.col("monto_autorizado").cast("string").alias("monto_autorizado"),
    )


@query
def lookup_chain(spark, sf_dir):
    ledger = b.ledger(spark, sf_dir, PMC)
    return lookup.enrich(ledger.autorizacion, ledger).select(
        "id", "ref_id", F.col("nombre_estado").alias("estado"), "comercio_id", "nombre_comercial"
    )


@query
def product_tier(spark, sf_dir):
    merchants = lookup.merchants(b.ledger(spark, sf_dir, PMC))
    return merchants.withColumnRenamed("_merchant", "comercio_id")


@query
def join_on_constant(spark, sf_dir):
    ledger = b.ledger(spark, sf_dir, PMC)
    flagged = lookup.flagged_merchants(ledger.comercio_configuracion)
    return ledger.comercio.join(flagged, F.col("id") == F.col("_flag_merchant"), "left").select(
        F.col("id").alias("comercio_id"), F.coalesce("_flagged", F.lit(False)).cast("int").alias("flagged")
    )


@query
def join_conditional(spark, sf_dir):
    ledger = b.ledger(spark, sf_dir, TRANSACCIONES)
    return lookup.with_signatures(ledger.autorizacion, ledger).select("id", "ref_id", "exitosa", "signature")


@query
def self_anti_empty(spark, sf_dir):
    """Lines that no line equals in its id: none but those without an id, which equal nothing."""
    lines = b.bind(spark, sf_dir, NULLED)
    return lines.join(lines.select("id"), "id", "left_anti")


@query
def matched_ids(spark, sf_dir):
    eligible = _eligible(spark, sf_dir)
    matched = match.matched_by_day(b.numbered_lineitem(spark, sf_dir), eligible, TRANSACCIONES)
    return matched.select(F.col(TRANSACCIONES.line_id).alias("line_id"))


@query
def unmatched_key_date(spark, sf_dir):
    eligible = _eligible(spark, sf_dir)
    others = match.unmatched_by_day(b.numbered_lineitem(spark, sf_dir), eligible, TRANSACCIONES)
    return others.select(F.col(TRANSACCIONES.line_id).alias("line_id"), TRANSACCIONES.key, "trx_date")


# Grouping and set operations


def _dedup(spark: SparkSession, sf_dir: str, lines: DataFrame, layout: Layout) -> DataFrame:
    found = Reduced(lines, b.ledger(spark, sf_dir, layout), layout)
    return _match_or_null(lines, found.picked, found.codes, layout)


@query
def dedup_reference(spark, sf_dir):
    return _dedup(spark, sf_dir, _pmc_lines(spark, sf_dir), PMC)


@query
def dedup_acquirer_code(spark, sf_dir):
    return _dedup(spark, sf_dir, b.bind(spark, sf_dir, b.MPOS_LINES), MPOS)


@query
def dedup_key_date(spark, sf_dir):
    ledger = b.ledger(spark, sf_dir, TRANSACCIONES)
    lines = b.numbered_lineitem(spark, sf_dir)
    rows = transacciones.joined_lines(lines, transacciones.reduced(lines, ledger, shared=True))
    return rows.filter("_authorization_id is not null").select(
        F.col(TRANSACCIONES.line_id).alias("line_id"),
        TRANSACCIONES.key,
        "id",
        F.col("_authorization_id").alias("autorizacion_id"),
        "ref_id",
        F.col("monto_autorizado").cast("string").alias("monto_autorizado"),
    )


@query
def fanout_count(spark, sf_dir):
    ledger = b.ledger(spark, sf_dir, MPOS)
    merchants = ledger.comercio.select("id", F.col("id").alias("comercio_id"))
    return lookup.with_links(merchants, ledger).select("comercio_id", F.col("_links").alias("joined_rows"))


def _unkeyed(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


@query
def union_distinct(spark, sf_dir):
    lines = b.bind(spark, sf_dir, b.PMC_REPEATED_LINES)
    keyed = lines.filter(prepare.nonempty(PMC.key)).select(*PMC.columns, F.lit("keyed").alias("arm"))
    others = lines.filter(_unkeyed(PMC.key)).select(*PMC.columns, F.lit("").alias("arm"))
    return keyed.unionByName(others).distinct()


@query
def unmatched_padding(spark, sf_dir):
    a = b.ledger(spark, sf_dir, PMC).autorizacion
    others = match.unmatched_lines(_pmc_lines(spark, sf_dir), a, PMC)
    return others.select(PMC.line_id, PMC.key, *common.padding(PMC))


# Scalar functions


@query
def null_default_export(spark, sf_dir):
    ledger = b.ledger(spark, sf_dir, MPOS)
    return lookup.enrich(ledger.autorizacion, ledger, by_id=True).select("id", *common.ledger_texts(MPOS))


@query
def null_default_dash(spark, sf_dir):
    return b.bind(spark, sf_dir, b.MPOS_LINES).select(MPOS.line_id, *common.file_columns(MPOS))


@query
def format_line_(spark, sf_dir):
    lines = b.bind(spark, sf_dir, b.PMC_LINES)
    return lines.select(PMC.line_id, format_line([F.col(c) for c in PMC.columns]).alias("line"))


@query
def text_date_prefix(spark, sf_dir):
    day = text_date(F.col("trx_date")).cast("string").alias("day")
    return b.bind(spark, sf_dir, DAY_TEXTS).select("l_orderkey", "l_linenumber", "trx_date", day)


# Pipelines


@query
def export_pmc(spark, sf_dir):
    return pmc.export(_pmc_lines(spark, sf_dir), b.ledger(spark, sf_dir, PMC))


@query
def stats_pmc(spark, sf_dir):
    return pmc.statistics(_pmc_lines(spark, sf_dir), b.ledger(spark, sf_dir, PMC))


@query
def stats_pmc_twins(spark, sf_dir):
    """Authorizations that differ in their reference alone: one not-found row, several export rows."""
    return pmc.statistics(_pmc_lines(spark, sf_dir), b.ledger(spark, sf_dir, PMC, b.TWINS))


@query
def export_pmc_merchant_id(spark, sf_dir):
    lines = _pmc_lines(spark, sf_dir, b.PMC_REPEATED_LINES)
    return pmc.export_merchant_id(lines, b.ledger(spark, sf_dir, PMC))


@query
def export_mpos(spark, sf_dir):
    return mpos.export(b.bind(spark, sf_dir, b.MPOS_LINES), b.ledger(spark, sf_dir, MPOS))


@query
def stats_mpos_grouped(spark, sf_dir):
    return mpos.statistics(b.bind(spark, sf_dir, b.MPOS_LINES), b.ledger(spark, sf_dir, MPOS))


@query
def export_trx(spark, sf_dir):
    return transacciones.export(b.numbered_lineitem(spark, sf_dir), b.ledger(spark, sf_dir, TRANSACCIONES))


@query
def stats_trx(spark, sf_dir):
    return transacciones.statistics(b.numbered_lineitem(spark, sf_dir), b.ledger(spark, sf_dir, TRANSACCIONES))


@query
def export_trx_merchant_id(spark, sf_dir):
    return transacciones.export_merchant_id(b.numbered_lineitem(spark, sf_dir), b.ledger(spark, sf_dir, TRANSACCIONES))


# Whole runs: a statement is written as a file, reconciled, and what the run wrote is read back.


def _run(spark: SparkSession, sf_dir: str, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """Export and log of a run; the statement's folder has the layout's name in its own."""
    if layout is TRANSACCIONES:
        rows = b.ordered_lineitem(spark, sf_dir)
    else:
        rows = b.bind(spark, sf_dir, b.PMC_LINES if layout is PMC else b.MPOS_LINES, ["event_id"])
    path, out = _write(spark, rows, layout), scratch_path(spark, f"run-{layout.name}")
    name = path.rsplit("/", 1)[-1]
    reconcile(spark, path, b.ledger(spark, sf_dir, layout), out, compression=PACKED)
    header = ", ".join(f"`{c}` string" for c in layout.header)
    export = spark.read.schema(header).option("header", True).option("escape", '"').csv(f"{out}/{export_name(name)}")
    return export.na.fill(""), spark.read.text(f"{out}/{statistics_name(name)}").withColumnRenamed("value", "line")


@query
def run_pmc(spark, sf_dir):
    return _run(spark, sf_dir, PMC)[0]


@query
def run_pmc_log(spark, sf_dir):
    return _run(spark, sf_dir, PMC)[1]


@query
def run_mpos(spark, sf_dir):
    return _run(spark, sf_dir, MPOS)[0]


@query
def run_mpos_log(spark, sf_dir):
    return _run(spark, sf_dir, MPOS)[1]


@query
def run_trx(spark, sf_dir):
    return _run(spark, sf_dir, TRANSACCIONES)[0]


@query
def run_trx_log(spark, sf_dir):
    return _run(spark, sf_dir, TRANSACCIONES)[1]
