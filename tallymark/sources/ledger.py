"""The ledger of card authorizations and its lookup tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.sources.scratch import write_through

# Ledger tables, the columns read from them, and the types their use requires.
TABLES: dict[str, dict[str, str]] = {
    "autorizacion": {
        "id": "bigint",
        "codigo_referencia": "string",
        "ref_id": "string",
        "codigo_unico_adq": "string",
        "fecha_hora_creacion": "timestamp",
        "exitosa": "int",
        "tarhab_email": "string",
        "hash_tarjeta": "string",
        "monto_autorizado": "decimal(18,2)",
        "numero_tarjeta_enmascarada": "string",
        "comercio_procesador_terminal_id": "bigint",
    },
    "transaccion": {"autorizacion_id": "bigint", "historial_transaccion_actual_id": "bigint", "comercio_id": "bigint"},
    "historial_transaccion": {"id": "bigint", "estado_transaccion_id": "bigint"},
    "estado_transaccion": {"id": "bigint", "nombre": "string", "estado_transaccion_usuario_id": "bigint"},
    "comercio": {"id": "bigint", "nombre_comercial": "string", "codigo_comercio": "string"},
    "comercio_adquiriente": {
        "id": "bigint",
        "comercio_id": "bigint",
        "comercio_contrato_id": "bigint",
        "adquiriente_id": "int",
    },
    "comercio_contrato": {"id": "bigint", "tipo_contrato_id": "int"},
    "comercio_procesador_terminal": {"id": "bigint", "comercio_adquiriente_id": "bigint"},
    "whitemarches": {"codigo_comercio": "string", "migration_date": "timestamp"},
    "comercio_configuracion": {"id": "bigint", "comercio_id": "bigint", "configuracion_id": "int"},
    "adq_vdp_v3_authorization": {"autorizacion_id": "bigint", "signature": "string"},
}

MERCHANT_ROW_BYTES = 64
# Shown as it is stored: another scale would change the amount.
AS_STORED = ("monto_autorizado",)


@dataclass(frozen=True)
class Ledger:
    """One DataFrame per ledger table. The tables' own ``id`` columns are primary keys; no other column has to be unique."""

    autorizacion: DataFrame
    transaccion: DataFrame
    historial_transaccion: DataFrame
    estado_transaccion: DataFrame
    comercio: DataFrame
    comercio_adquiriente: DataFrame
    comercio_contrato: DataFrame
    comercio_procesador_terminal: DataFrame
    whitemarches: DataFrame
    comercio_configuracion: DataFrame
    adq_vdp_v3_authorization: DataFrame

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame]) -> Ledger:
        """A ledger from DataFrames; only the columns of ``TABLES`` are read, cast to their types."""
        return cls(**{f.name: conform(tables[f.name], f.name) for f in fields(cls)})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> Ledger:
        """One parquet table per name under ``root``."""
        return cls.of({name: spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in TABLES})

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        options: Mapping[str, str],
        *,
        schema: str | None = None,
        partitioning: Mapping[str, Mapping[str, str]] | None = None,
        snapshot: bool = True,
    ) -> Ledger:
        """Read the tables over JDBC, by default once: each is written to the shared folder and read from there.

        Every output of a run then sees the same rows, counts come from file footers, and sizes are known to the planner.

        ``options`` holds url, driver, user and password, which the caller takes from its configuration or secret
        store. ``partitioning`` gives partitionColumn, lowerBound, upperBound and numPartitions per table; without
        them a table is read by one task, so set them for every large table.
        """
        live = cls.of(
            {
                name: spark.read.format("jdbc").options(**jdbc_options(name, options, schema, partitioning)).load()
                for name in TABLES
            }
        )
        return live.snapshot() if snapshot else live

    def snapshot(self) -> Ledger:
        """The same tables, written once."""
        return Ledger(**{f.name: write_through(getattr(self, f.name), f"ledger-{f.name}") for f in fields(self)})

    def with_tables(self, **tables: DataFrame) -> Ledger:
        """A ledger with some tables in place of its own; the measured size of the merchants stays known while they stay."""
        changed = replace(self, **tables)
        if "comercio" not in tables and "merchant_bytes" in self.__dict__:
            changed.__dict__["merchant_bytes"] = self.merchant_bytes
        return changed

    @cached_property
    def transaction_count(self) -> int:
        """Rows of the transaction table; parquet answers this from its footers."""
        return self.transaccion.count()

    @cached_property
    def merchant_bytes(self) -> int:
        """Size of the merchants as the lookups need them: id, name, tier and row headers."""
        row = F.coalesce(F.octet_length("nombre_comercial"), F.lit(0)) + MERCHANT_ROW_BYTES
        return self.comercio.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0


def jdbc_options(
    table: str,
    options: Mapping[str, str],
    schema: str | None = None,
    partitioning: Mapping[str, Mapping[str, str]] | None = None,
) -> dict[str, str]:
    """Reader options of one table."""
    return {
        **options,
        "dbtable": f"{schema}.{table}" if schema else table,
        **(partitioning or {}).get(table, {}),
    }


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns of a ledger table in their types; a timestamp without time zone stays one, and so does an amount."""
    present = dict(df.dtypes)
    return df.select(
        *(
            F.col(c) if c in AS_STORED or present.get(c) in (kind, f"{kind}_ntz") else F.col(c).cast(kind).alias(c)
            for c, kind in TABLES[table].items()
        )
    )
