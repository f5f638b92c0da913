"""The three statement layouts and the columns of their exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# File columns and export headers, in file order. They are the interface of the statement files
# and of whatever reads the exports, so they are kept letter for letter.
PMC_COLUMNS = (
    "fecha_hora nro_orden seccode marca tarjeta monto abonado cod_auto dc cod_com comercio usuario_txn usuario_dp "
    "status_adquiriente"
).split()
MPOS_COLUMNS = (
    "RUC Cod_Comercio Producto Moneda Fecha_operacion Tipo_operacion id_operacion Estado Motivo_venta_observada Monto "
    "N_serie_terminal Codigo_autorizacion N_referencia N_lote Monto_DCC DCC N_tarjeta Origen_tarjeta Tipo_tarjeta "
    "Marca_tarjeta Tipo_captura Banco_emisor Numero_de_cuenta Banco_Pagador N_cuotas Trx_cuotas_sin_intereses "
    "Nombre_del_programa Importe_descontado"
).split()
TRANSACCIONES_COLUMNS = (
    "ruc commerce_id channel id trx_date shop_po_number currency order_amount auth_payment settled_amount bin pan brand "
    "cardholder cardholder_email state authorization_code authorization_message confirmation_date annulation_date "
    "annulation_reason eci xid cavv dccAmount dccExchangeRate panEnc dccIndicator registerFrequent useFrequent "
    "id_procesador brandActionCode"
).split()
MERCHANT_ID, MERCHANT_ID_V4 = "comercio_id", "id_comercio"
STATE = "estado_culqi"
TRANSACCIONES_LINE_ID = "id_culqi"
TIER = "tipo_bln"

# Export header of the ledger columns -> name of the column inside the pipelines.
_AUTHORIZATION = {
    "nombre_comercio": "nombre_comercial",
    "fecha_hora_creacion": "fecha_hora_creacion",
    "exitosa": "exitosa",
    "tarhab_email": "tarhab_email",
    "hash_tarjeta": "hash_tarjeta",
    "monto_autorizado": "monto_autorizado",
    "numero_tarjeta_enmascarada": "numero_tarjeta_enmascarada",
    STATE: "nombre_estado",
    "codigo_referencia": "codigo_referencia",
    "codigo_unico_adq": "codigo_unico_adq",
}
_TAIL = {TIER: TIER, "ref_id": "ref_id"}


@dataclass(frozen=True)
class Layout:
    """One statement layout: how to recognise and read a file, and what its export looks like."""

    name: str
    delimiter: str
    columns: tuple[str, ...]
    line_id: str
    key: str
    ledger_key: str
    match_columns: tuple[str, ...]  # ledger columns that make one export row per line
    ledger_columns: dict[str, str]
    day: str | None = None
    duplicate: str | None = None  # file column that tells lines of one key apart
    drop_empty_key: bool = False
    defaults: tuple[tuple[str, str], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def header(self) -> list[str]:
        return [*self.columns, self.line_id, *self.ledger_columns]


PMC = Layout(
    name="PMC",
    delimiter=",",
    columns=tuple(PMC_COLUMNS),
    line_id="id",
    key="nro_orden",
    ledger_key="codigo_referencia",
    match_columns=("codigo_referencia", "ref_id"),
    ledger_columns={**_AUTHORIZATION, **_TAIL},
    drop_empty_key=True,
)
MPOS = Layout(
    name="MPOS",
    delimiter=",",
    columns=tuple(MPOS_COLUMNS),
    line_id="id",
    key="id_operacion",
    ledger_key="codigo_unico_adq",
    match_columns=("codigo_referencia", "ref_id", "codigo_unico_adq"),
    ledger_columns={MERCHANT_ID: "comercio_id", **_AUTHORIZATION, **_TAIL},
    defaults=(("Importe_descontado", "-"),),
)
TRANSACCIONES = Layout(
    name="TRANSACCIONES",
    delimiter=";",
    columns=tuple(TRANSACCIONES_COLUMNS),
    line_id=TRANSACCIONES_LINE_ID,
    key="id_procesador",
    ledger_key="codigo_unico_adq",
    match_columns=("codigo_unico_adq", "auth_day"),
    ledger_columns={**_AUTHORIZATION, "signature": "signature", **_TAIL},
    day="trx_date",
    duplicate="id",
)

# Order matters: a name that contains several of these words belongs to the first.
LAYOUTS = (PMC, MPOS, TRANSACCIONES)


def layout_for(file_name: str) -> Layout | None:
    """The layout of one file, by its name; None for a name that fits no layout."""
    return next((layout for layout in LAYOUTS if layout.name in file_name.upper()), None)
