"""Statement lines and ledger tables as views of the test tables.

Each relation is one SELECT that Spark and DuckDB both understand. ``{name}`` stands for a test table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from tallymark.operators.prepare import assign_row_id
from tallymark.sources.layouts import MPOS, PMC, TRANSACCIONES, Layout
from tallymark.sources.ledger import Ledger

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
T = TypeVar("T")
LINEITEM_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]

EVENT_KEY = "case when event_type = 'error' then '' else cast(event_id * 2 as string) end"
EVENT_DAY = "cast(cast(ts as date) as string)"
EVENT_AMOUNT = "cast(cast(value as decimal(18,2)) as string)"

PMC_VALUES = {
    "fecha_hora": EVENT_DAY,
    "nro_orden": EVENT_KEY,
    "seccode": "event_type",
    "marca": "upper(event_type)",
    "tarjeta": "concat('**** ', cast(user_id as string))",
    "monto": EVENT_AMOUNT,
    "abonado": "''",
    "cod_auto": "props",
    "dc": "case when value > 50 then 'D' else 'C' end",
    "cod_com": "cast(user_id as string)",
    "comercio": "concat('Café, \"', event_type, '\"')",
    "usuario_txn": "concat('u', cast(user_id as string))",
    "usuario_dp": "case when event_type = 'signup' then cast(null as string) else 'dp' end",
    "status_adquiriente": "case when event_type = 'view' then cast(null as string) else 'OK' end",
}
# Four neighbouring events share a key, and only the event type tells their lines apart: identical lines occur.
PMC_REPEATED_VALUES = {
    **{c: "event_type" for c in PMC.columns},
    "nro_orden": "case when event_type = 'error' then '' else cast((event_id - event_id % 4) * 2 as string) end",
}
MPOS_VALUES = {
    **{c: "event_type" for c in MPOS.columns},
    "RUC": "cast(user_id as string)",
    "Cod_Comercio": "concat('C', cast(user_id as string))",
    "Fecha_operacion": EVENT_DAY,
    "id_operacion": EVENT_KEY,
    "Monto": EVENT_AMOUNT,
    "Codigo_autorizacion": "props",
    "N_tarjeta": "concat('**** ', cast(user_id as string))",
    "Nombre_del_programa": "concat('Año; \"', event_type, '\"')",
    "Importe_descontado": "case when event_type = 'view' then cast(null as string) else '1.50' end",
}
TRANSACCIONES_VALUES = {
    **{c: "''" for c in TRANSACCIONES.columns},
    "ruc": "cast(l_suppkey as string)",
    "commerce_id": "cast(l_partkey as string)",
    "channel": "l_returnflag",
    "id": "cast(l_linenumber as string)",
    "trx_date": "cast(case when l_quantity >= 25 then l_shipdate + interval 1 day else l_shipdate end as string)",
    "shop_po_number": "cast(l_orderkey as string)",
    "currency": "l_linestatus",
    "order_amount": "cast(cast(l_extendedprice as decimal(18,2)) as string)",
    "auth_payment": "cast(cast(l_discount as decimal(18,2)) as string)",
    "settled_amount": "cast(cast(l_tax as decimal(18,2)) as string)",
    "state": "case when l_linestatus = 'F' then 'settled' else 'open' end",
    "id_procesador": "case when l_returnflag = 'R' and l_linenumber = 1 then '' else cast(l_orderkey as string) end",
}


def _select(values: dict[str, str], table: str, **extra: str) -> str:
    columns = {**values, **extra}
    return f"select {', '.join(f'{value} as {name}' for name, value in columns.items())} from {{{table}}}"


PMC_LINES = _select(PMC_VALUES, "events", id="event_id")
PMC_REPEATED_LINES = _select(PMC_REPEATED_VALUES, "events", id="event_id")
MPOS_LINES = _select(MPOS_VALUES, "events", id="event_id")
TRANSACCIONES_LINES = _select(
    TRANSACCIONES_VALUES,
    "lineitem",
    **{TRANSACCIONES.line_id: f"row_number() over (order by {', '.join(LINEITEM_COLUMNS)})"},
)

# Statements as files may hold them: line ends in quoted values, blank lines behind some lines, and too many fields in some.
ODD_TEXT = "case when {n} % 7 = 0 then concat('one, \"', {text}, '\"', chr(10), chr(10), 'two; ', {text}) else {text} end"
PMC_ODD_LINES = _select({**PMC_VALUES, "cod_auto": ODD_TEXT.format(n="event_id", text="props")}, "events", id="event_id")
MPOS_ODD_LINES = _select({**MPOS_VALUES, "Codigo_autorizacion": ODD_TEXT.format(n="event_id", text="props")}, "events", id="event_id")
BLANK_BEHIND, SURPLUS_IN = "{id} % 11 = 0", "{id} % 13 = 0"

ORDER_CODE, PART_CODE = "cast(l_orderkey as string)", "cast(l_partkey as string)"


def _authorizations(reference: str, code: str) -> str:
    return f"""select l_orderkey as id, {reference} as codigo_referencia, cast(l_linenumber as string) as ref_id,
        {code} as codigo_unico_adq, l_shipdate as fecha_hora_creacion,
        case when l_returnflag = 'R' then 0 else 1 end as exitosa,
        concat('payer', cast(l_suppkey as string), '@example.com') as tarhab_email,
        md5({PART_CODE}) as hash_tarjeta, cast(l_extendedprice as decimal(18,2)) as monto_autorizado,
        concat('4111********', cast(l_linenumber as string)) as numero_tarjeta_enmascarada,
        l_suppkey as comercio_procesador_terminal_id from {{lineitem}}"""


# Every third order has each of its authorizations once more, with another reference and nothing else changed.
TWINS = "PMC twins"
PMC_AUTHORIZATIONS = _authorizations(ORDER_CODE, PART_CODE)
PMC_TWINS = f"""{PMC_AUTHORIZATIONS} union all select id, codigo_referencia, concat('again ', ref_id) as ref_id, codigo_unico_adq, fecha_hora_creacion,
    exitosa, tarhab_email, hash_tarjeta, monto_autorizado, numero_tarjeta_enmascarada, comercio_procesador_terminal_id
    from ({PMC_AUTHORIZATIONS}) where id % 3 = 0"""

# Ledger table -> SELECT; the authorizations depend on the layout.
AUTHORIZATIONS = {
    TWINS: PMC_TWINS,
    PMC.name: PMC_AUTHORIZATIONS,
    MPOS.name: _authorizations(PART_CODE, ORDER_CODE),
    TRANSACCIONES.name: _authorizations(PART_CODE, ORDER_CODE),
}
LEDGER = {
    "transaccion": """select o_orderkey as autorizacion_id, o_custkey as historial_transaccion_actual_id,
        o_custkey as comercio_id from {orders}""",
    "historial_transaccion": "select c_custkey as id, cast(c_nationkey as bigint) as estado_transaccion_id from {customer}",
    "estado_transaccion": """select cast(n_nationkey as bigint) as id, n_name as nombre,
        cast(n_regionkey as bigint) as estado_transaccion_usuario_id from {nation} where n_regionkey <> 0""",
    "comercio": "select c_custkey as id, c_name as nombre_comercial, c_name as codigo_comercio from {customer}",
    "comercio_adquiriente": """select s_suppkey as id, cast(null as bigint) as comercio_id,
        s_suppkey as comercio_contrato_id, case when s_nationkey < 15 then 4 else 5 end as adquiriente_id from {supplier}""",
    "comercio_contrato": "select p_partkey as id, 1 as tipo_contrato_id from {part}",
    "comercio_procesador_terminal": "select s_suppkey as id, s_suppkey as comercio_adquiriente_id from {supplier}",
    "whitemarches": """select c_name as codigo_comercio,
        case when c_acctbal < 0 then cast(null as timestamp) else cast('2019-01-01 00:00:00' as timestamp) end
        as migration_date from {customer} where c_mktsegment = 'BUILDING'""",
    "comercio_configuracion": """select c_custkey as id, c_custkey as comercio_id,
        case when c_mktsegment in ('BUILDING', 'MACHINERY') then 11 else 12 end as configuracion_id from {customer}""",
    "adq_vdp_v3_authorization": """select o_orderkey as autorizacion_id, o_orderpriority as signature
        from {orders} where o_orderstatus = 'F'""",
}
# Where merchants have several acquirer links each: the orders of a customer.
MERCHANT_LINKS = """select o_orderkey as id, o_custkey as comercio_id, o_orderkey as comercio_contrato_id, 4 as adquiriente_id from {orders}"""


def ledger_tables(layout: Layout) -> dict[str, str]:
    """SELECTs of the lookup tables. Only the day-matched layout reads terminals' acquirer links, the others merchants'."""
    return LEDGER if layout is TRANSACCIONES else {**LEDGER, "comercio_adquiriente": MERCHANT_LINKS}


# Definitions and staged tables are made once per application and folder: they hold no rows, only plans and schemas.
_known: dict[tuple[str, ...], DataFrame | Ledger] = {}


def _once(spark: SparkSession, *name: str, make: Callable[[], T]) -> T:
    application = spark.sparkContext.applicationId
    known = (application, *name)
    if known not in _known:
        for old in [k for k in _known if k[0] != application]:
            del _known[old]
        _known[known] = make()
    return _known[known]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return _once(spark, path, make=lambda: spark.read.parquet(path))


def bind(spark: SparkSession, sf_dir: str, select: str, order: Sequence[str] = ()) -> DataFrame:
    """A relation over the parquet tables it names. ``order``, of a single table's columns: its rows are sorted while they are narrow."""
    tables = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in select}
    return spark.sql(select, **{t: rows.orderBy(*order) if order else rows for t, rows in tables.items()})


def ledger(spark: SparkSession, sf_dir: str, layout: Layout, authorizations: str | None = None) -> Ledger:
    kind = authorizations or layout.name

    def make() -> Ledger:
        selects = {"autorizacion": AUTHORIZATIONS[kind], **ledger_tables(layout)}
        return Ledger.of({name: bind(spark, sf_dir, select) for name, select in selects.items()})

    return _once(spark, sf_dir, "ledger", kind, make=make)


def ordered_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the day-matched layout in the order of their numbers, for a file, which holds no numbers. Rows are sorted
    while they are narrow."""
    rows = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS).orderBy(*LINEITEM_COLUMNS)
    return spark.sql(_select(TRANSACCIONES_VALUES, "rows"), rows=rows)


def numbered_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the day-matched layout, numbered over the whole table.

    The rows are numbered and written once per application, as a statement is staged once and then read by export and
    statistics. The layout's texts are made when they are read.
    """

    def make() -> DataFrame:
        rows = table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
        return assign_row_id(rows, TRANSACCIONES.line_id, order_by=LINEITEM_COLUMNS)

    numbered = _once(spark, sf_dir, "numbered", make=make)
    line_id = {TRANSACCIONES.line_id: TRANSACCIONES.line_id}
    return spark.sql(_select(TRANSACCIONES_VALUES, "rows", **line_id), rows=numbered)
