"""SQL that computes each registered query from the described behaviour, for DuckDB on the same tables.

The statements and ledger tables are the shared bindings. Everything on top is written on its own: what is known of a
merchant, a transaction and an authorization is put together in one relation each, and rows are grouped after the join.
"""

from __future__ import annotations

from tallymark.sources.layouts import MPOS, PMC, TIER, TRANSACCIONES, Layout
from tallymark.workload import bindings as b
from tallymark.workload.queries import DAY_TEXTS, FILE_NAME, KEYS, NULLED

TRX_ID = TRANSACCIONES.line_id

# Relations on the ledger, each on the ones before it.
KNOWN = {
    "merchant": """SELECT id AS merchant_id, nombre_comercial AS merchant_name, CASE
        WHEN codigo_comercio IN (SELECT codigo_comercio FROM whitemarches WHERE migration_date IS NOT NULL) THEN 't0 (Evolution)'
        WHEN id IN (SELECT comercio_id FROM comercio_configuracion WHERE configuracion_id = 11 AND id IS NOT NULL) THEN 'Ledger'
        ELSE 'T+n (Core)' END AS tier FROM comercio""",
    "state": """SELECT historial_transaccion.id AS history_id, estado_transaccion.nombre AS state_name
        FROM estado_transaccion JOIN historial_transaccion ON estado_transaccion_id = estado_transaccion.id""",
    "payment": """SELECT autorizacion_id AS paid, historial_transaccion_actual_id AS history_id, comercio_id AS paid_to,
        state_name, merchant_id, merchant_name, tier
        FROM transaccion LEFT JOIN state ON history_id = historial_transaccion_actual_id LEFT JOIN merchant ON merchant_id = comercio_id""",
    "known": "SELECT * FROM autorizacion LEFT JOIN payment ON paid = id",
    "acquired": """SELECT comercio_id AS owner, count(*) AS links FROM comercio_adquiriente
        WHERE comercio_id IN (SELECT id FROM comercio) GROUP BY comercio_id""",
    "answer": "SELECT autorizacion_id AS answered, signature FROM adq_vdp_v3_authorization",
    "terminal": """SELECT id AS terminal_id FROM comercio_procesador_terminal WHERE comercio_adquiriente_id IN (
        SELECT id FROM comercio_adquiriente WHERE adquiriente_id = 4 AND comercio_contrato_id IN (
            SELECT id FROM comercio_contrato WHERE tipo_contrato_id = 1))""",
    "eligible": """SELECT *, CAST(fecha_hora_creacion AS date) AS made_on FROM known
        LEFT JOIN answer ON answered = id AND exitosa = 0
        WHERE comercio_procesador_terminal_id IN (SELECT terminal_id FROM terminal)""",
}
# Least authorization, then least transaction, NULL first.
PICK_ORDER = ", ".join(
    f"known.{c} NULLS FIRST"
    for c in (
        "id", "fecha_hora_creacion", "monto_autorizado", "exitosa", "codigo_unico_adq", "codigo_referencia", "ref_id", "tarhab_email",
        "hash_tarjeta", "numero_tarjeta_enmascarada", "comercio_procesador_terminal_id", "history_id", "paid_to",
    )
)
# Names of the relations above for what the layouts call by other names.
COLUMN_OF = {
    "nombre_comercial": "known.merchant_name",
    "nombre_estado": "known.state_name",
    "comercio_id": "known.merchant_id",
    TIER: "coalesce(known.tier, 'T+n (Core)')",
}


def _sql(select: str) -> str:
    return select.format(**{t: t for t in b.TABLES})


def _with(layout: Layout, lines: str, authorizations: str | None = None, **more: str) -> str:
    tables = {"lines": _sql(lines), "autorizacion": _sql(b.AUTHORIZATIONS[authorizations or layout.name])}
    tables |= {name: _sql(select) for name, select in b.ledger_tables(layout).items()}
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in {**tables, **KNOWN, **more}.items()) + " "


BY_CODE = {
    layout.name: f"FROM lines line LEFT JOIN known ON known.{layout.ledger_key} = line.{layout.key}" for layout in (PMC, MPOS)
}
GROUP = {layout.name: ", ".join([*(f"known.{c}" for c in layout.match_columns), "line.id"]) for layout in (PMC, MPOS)}
BY_DAY = """FROM lines line JOIN eligible known ON line.id_procesador = known.codigo_unico_adq AND line.id_procesador <> ''
    AND CAST(try_strptime(substr(line.trx_date, 1, 10), '%Y-%m-%d') AS date) = known.made_on"""
KEPT_PMC = "nro_orden is null or nro_orden <> ''"
PMC_KEPT_LINES = f"select * from ({b.PMC_LINES}) where {KEPT_PMC}"
NUMBERED_PMC = f"select * replace (row_number() over (order by id) as id) from ({PMC_KEPT_LINES})"
NUMBERED_MPOS = f"select * replace (row_number() over (order by id) as id) from ({b.MPOS_LINES})"
PMC_REPEATED_KEPT_LINES = f"select * from ({b.PMC_REPEATED_LINES}) where {KEPT_PMC}"


def _file_columns(layout: Layout) -> str:
    defaults = dict(layout.defaults)
    return ", ".join(f"coalesce(line.{c}, '{defaults[c]}') as {c}" if c in defaults else f"line.{c}" for c in layout.columns)


def _ledger_columns(layout: Layout) -> str:
    pairs = ((COLUMN_OF.get(source, f"known.{source}"), header) for header, source in layout.ledger_columns.items())
    return ", ".join(f"coalesce(cast({value} as varchar), '') as {header}" for value, header in pairs)


def _empty_ledger_columns(layout: Layout) -> str:
    return ", ".join(f"'' as {header}" for header in layout.ledger_columns)


def _export_by_code(layout: Layout, lines: str, line_id: str = "line.id", distinct: str = "") -> str:
    return (
        _with(layout, lines)
        + f"""SELECT {distinct} * EXCLUDE (rn) FROM (
        SELECT {_file_columns(layout)}, {line_id} as id, {_ledger_columns(layout)},
            row_number() over (partition by {GROUP[layout.name]} order by {PICK_ORDER}) as rn
        {BY_CODE[layout.name]} where line.{layout.key} <> '') WHERE rn = 1"""
    )


def _export_by_day(merchant_id: bool) -> str:
    merchant, none = "", ""
    if merchant_id:
        merchant, none = "coalesce(cast(known.merchant_id as varchar), '') as id_comercio,", "'' as id_comercio,"
    return (
        _with(TRANSACCIONES, b.TRANSACCIONES_LINES)
        + f"""SELECT * EXCLUDE (rn) FROM (
        SELECT {_file_columns(TRANSACCIONES)}, {merchant} line.{TRX_ID}, {_ledger_columns(TRANSACCIONES)},
            row_number() over (partition by line.id_procesador, line.id order by line.{TRX_ID}, {PICK_ORDER}) as rn
        {BY_DAY}) WHERE rn = 1
        UNION ALL
        SELECT {_file_columns(TRANSACCIONES)}, {none} line.{TRX_ID}, {_empty_ledger_columns(TRANSACCIONES)} FROM lines line
        WHERE line.{TRX_ID} NOT IN (SELECT line.{TRX_ID} {BY_DAY})"""
    )


MATCH_VALUES = """known.id as autorizacion_id, known.codigo_referencia, known.ref_id, known.codigo_unico_adq,
    cast(known.monto_autorizado as varchar) as monto_autorizado"""


def _match(layout: Layout, lines: str) -> str:
    return (
        _with(layout, lines)
        + f"""SELECT line.id, line.{layout.key}, {MATCH_VALUES} FROM lines line
        LEFT JOIN autorizacion known ON known.{layout.ledger_key} = line.{layout.key} WHERE line.{layout.key} <> ''"""
    )


def _dedup(layout: Layout, lines: str) -> str:
    return (
        _with(layout, lines)
        + f"""SELECT * EXCLUDE (rn) FROM (SELECT line.id, line.{layout.key}, {MATCH_VALUES},
            row_number() over (partition by {GROUP[layout.name]} order by {PICK_ORDER}) as rn
        {BY_CODE[layout.name]} WHERE line.{layout.key} <> '') WHERE rn = 1"""
    )


def _metric(metric: str, label: str | None, value: str) -> str:
    text = f"'{label}'" if label else "cast(null as varchar)"
    return f"SELECT '{metric}' as metric, {text} as label, cast(({value}) as bigint) as value"


def _counts(lines: str = "SELECT count(*) FROM lines") -> str:
    return f"{_metric('input', 'Input: ', lines)} UNION ALL {_metric('output_declared', 'Output: ', lines)} UNION ALL "


def _read_back(export: str) -> str:
    """An export as its file shows it: texts, empty for NULL."""
    return f"SELECT coalesce(CAST(COLUMNS(*) AS varchar), '') FROM ({export})"


def _log(statistics: str) -> str:
    return f"SELECT label || chr(9) || value AS line FROM ({statistics}) WHERE label IS NOT NULL"


def _stats_pmc(authorizations: str) -> str:
    """Groups whose shown columns are equal are one not-found row; the reference of a group is not among them."""
    shown = [*(c for c in PMC.ledger_columns.values() if c not in (TIER, "ref_id"))]
    columns = ", ".join(f"{COLUMN_OF.get(c, f'known.{c}')} as {c}" for c in shown)
    grouped = f"""SELECT line.id, {columns}, row_number() over (partition by {GROUP['PMC']} order by {PICK_ORDER}) as rn
        {BY_CODE['PMC']} WHERE line.nro_orden <> ''"""
    return (
        _with(PMC, PMC_KEPT_LINES, authorizations, grouped=f"SELECT * EXCLUDE (rn) FROM ({grouped}) WHERE rn = 1")
        + _counts()
        + _metric(
            "not_found",
            "No Encontrados: ",
            "SELECT count(*) FROM (SELECT DISTINCT * FROM grouped WHERE coalesce(nombre_estado, '') = '')",
        )
        + " UNION ALL "
        + _metric("output_rows", None, "SELECT count(*) FROM grouped")
    )


def _stats_mpos() -> str:
    return (
        _with(MPOS, b.MPOS_LINES)
        + _counts()
        + f"""SELECT 'not_found' as metric, 'No Encontrados: ' as label, cast(sum(coalesce(links, 1)) as bigint) as value
        {BY_CODE['MPOS']} LEFT JOIN acquired ON owner = known.merchant_id
        WHERE (line.id_operacion <> '' AND state_name IS NULL) OR state_name = ''
        GROUP BY known.codigo_referencia, known.ref_id, known.codigo_unico_adq"""
    )


def _stats_trx() -> str:
    matched = f"SELECT line.{TRX_ID} as line_id, line.id_procesador, line.id {BY_DAY}"
    unmatched = f"SELECT count(*) FROM lines WHERE {TRX_ID} NOT IN (SELECT line_id FROM matched)"
    groups = "SELECT count(*) FROM (SELECT DISTINCT id_procesador, id FROM matched)"
    return (
        _with(TRANSACCIONES, b.TRANSACCIONES_LINES, matched=matched)
        + _counts()
        + _metric("not_found", "No Encontrados: ", unmatched)
        + " UNION ALL "
        + _metric("output_rows", None, f"({unmatched}) + ({groups})")
    )


def _load(layout: Layout, lines: str, line_id: str, keep: str = "true") -> str:
    return _sql(
        f"""SELECT {', '.join(layout.columns)}, row_number() over (order by {line_id}) as {line_id}
        FROM ({lines}) WHERE {keep}"""
    )


def oracle() -> dict[str, str]:
    day_join = _with(TRANSACCIONES, b.TRANSACCIONES_LINES)
    pmc = _with(PMC, PMC_KEPT_LINES)
    quoted = " || ',' || ".join(f"'\"' || {c} || '\"'" for c in PMC.columns)
    return {
        "route_layout": _sql(
            f"""SELECT event_id, file_name, CASE WHEN upper(file_name) LIKE '%PMC%' THEN 'PMC'
            WHEN upper(file_name) LIKE '%MPOS%' THEN 'MPOS' WHEN upper(file_name) LIKE '%TRANSACCIONES%' THEN 'TRANSACCIONES'
            ELSE 'none' END as layout FROM ({FILE_NAME})"""
        ),
        "load_statement_pmc": _load(PMC, b.PMC_LINES, "id", KEPT_PMC),
        "load_statement_mpos": _load(MPOS, b.MPOS_LINES, "id"),
        "load_statement_transacciones": _load(TRANSACCIONES, b.TRANSACCIONES_LINES, TRX_ID),
        "load_odd_pmc": _load(PMC, b.PMC_ODD_LINES, "id", KEPT_PMC),
        "load_odd_mpos": _sql(
            f"""SELECT {', '.join(MPOS.columns)}, row_number() over (order by place, behind) as id FROM (
            SELECT {', '.join(MPOS.columns)}, id as place, 0 as behind FROM ({b.MPOS_ODD_LINES}) UNION ALL
            SELECT {', '.join(f"'' as {c}" for c in MPOS.columns)}, id as place, 1 as behind FROM ({b.MPOS_ODD_LINES})
            WHERE {b.BLANK_BEHIND.format(id="id")})"""
        ),
        "rejected_records": _sql(
            f"""SELECT 'fields' as reason, true as loaded, 'surplus' as last_field, RUC FROM ({b.MPOS_ODD_LINES})
            WHERE {b.SURPLUS_IN.format(id="id")}"""
        ),
        "drop_empty_key": _sql(f"SELECT * FROM ({KEYS}) WHERE {KEPT_PMC}"),
        "nonempty_key": _sql(f"SELECT * FROM ({KEYS}) WHERE nro_orden <> ''"),
        "assign_row_id": _sql(
            f"""SELECT id as event_id, nro_orden, row_number() over (order by id) as id
            FROM ({KEYS}) WHERE {KEPT_PMC}"""
        ),
        "match_reference": _match(PMC, PMC_KEPT_LINES),
        "match_acquirer_code": _match(MPOS, b.MPOS_LINES),
        "match_key_date": day_join
        + f"""SELECT line.{TRX_ID} as line_id, line.id_procesador, line.trx_date, known.id as autorizacion_id, known.ref_id,
            cast(known.monto_autorizado as varchar) as monto_autorizado {BY_DAY}""",
        "lookup_chain": pmc
        + "SELECT id, ref_id, state_name as estado, merchant_id as comercio_id, merchant_name as nombre_comercial FROM known",
        "product_tier": pmc
        + "SELECT merchant_id as comercio_id, merchant_name as nombre_comercial, tier as tipo_bln FROM merchant",
        "join_on_constant": pmc
        + """SELECT id as comercio_id, CAST(id IN (SELECT comercio_id FROM comercio_configuracion WHERE configuracion_id = 11)
            AS integer) as flagged FROM comercio""",
        "join_conditional": day_join
        + "SELECT id, ref_id, exitosa, signature FROM autorizacion LEFT JOIN answer ON answered = id AND exitosa = 0",
        "self_anti_empty": _sql(f"WITH lines AS ({NULLED}) ")
        + "SELECT id, nro_orden FROM lines one WHERE NOT EXISTS (SELECT 1 FROM lines other WHERE other.id = one.id)",
        "matched_ids": day_join + f"SELECT DISTINCT line.{TRX_ID} as line_id {BY_DAY}",
        "unmatched_key_date": day_join
        + f"""SELECT line.{TRX_ID} as line_id, line.id_procesador, line.trx_date FROM lines line
            WHERE line.{TRX_ID} NOT IN (SELECT line.{TRX_ID} {BY_DAY})""",
        "dedup_reference": _dedup(PMC, PMC_KEPT_LINES),
        "dedup_acquirer_code": _dedup(MPOS, b.MPOS_LINES),
        "dedup_key_date": day_join
        + f"""SELECT * EXCLUDE (rn) FROM (SELECT line.{TRX_ID} as line_id, line.id_procesador, line.id, known.id as autorizacion_id,
            known.ref_id, cast(known.monto_autorizado as varchar) as monto_autorizado,
            row_number() over (partition by line.id_procesador, line.id order by line.{TRX_ID}, {PICK_ORDER}) as rn
            {BY_DAY}) WHERE rn = 1""",
        "fanout_count": """SELECT c_custkey as comercio_id, count(*) as joined_rows FROM customer
            LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
        "union_distinct": _with(PMC, b.PMC_REPEATED_LINES)
        + f"""SELECT {', '.join(PMC.columns)}, 'keyed' as arm FROM lines WHERE nro_orden <> ''
            UNION SELECT {', '.join(PMC.columns)}, '' as arm FROM lines WHERE nro_orden = '' OR nro_orden IS NULL""",
        "unmatched_padding": pmc
        + f"""SELECT id, nro_orden, {_empty_ledger_columns(PMC)} FROM lines WHERE nro_orden <> ''
            AND nro_orden NOT IN (SELECT codigo_referencia FROM autorizacion WHERE codigo_referencia IS NOT NULL)""",
        "null_default_export": _with(MPOS, b.MPOS_LINES)
        + f"SELECT known.id, {_ledger_columns(MPOS)} FROM known",
        "null_default_dash": _with(MPOS, b.MPOS_LINES) + f"SELECT line.id, {_file_columns(MPOS)} FROM lines line",
        "format_line": _with(PMC, b.PMC_LINES) + f"SELECT id, {quoted} as line FROM lines",
        "text_date_prefix": _sql(
            f"""SELECT l_orderkey, l_linenumber, trx_date,
            cast(cast(try_strptime(substr(trx_date, 1, 10), '%Y-%m-%d') as date) as varchar) as day FROM ({DAY_TEXTS})"""
        ),
        "export_pmc": _export_by_code(PMC, PMC_KEPT_LINES),
        "stats_pmc": _stats_pmc(PMC.name),
        "stats_pmc_twins": _stats_pmc(b.TWINS),
        "export_pmc_merchant_id": _export_by_code(
            PMC, PMC_REPEATED_KEPT_LINES, "coalesce(cast(known.merchant_id as varchar), '')", "DISTINCT"
        ),
        "export_mpos": _export_by_code(MPOS, b.MPOS_LINES),
        "stats_mpos_grouped": _stats_mpos(),
        "export_trx": _export_by_day(merchant_id=False),
        "stats_trx": _stats_trx(),
        "export_trx_merchant_id": _export_by_day(merchant_id=True),
        "run_pmc": _read_back(_export_by_code(PMC, NUMBERED_PMC)),
        "run_pmc_log": _log(_stats_pmc(PMC.name)),
        "run_mpos": _read_back(_export_by_code(MPOS, NUMBERED_MPOS)),
        "run_mpos_log": _log(_stats_mpos()),
        "run_trx": _read_back(_export_by_day(merchant_id=False)),
        "run_trx_log": _log(_stats_trx()),
    }
