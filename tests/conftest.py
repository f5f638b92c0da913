from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallymark.session import SETTINGS  # noqa: E402
from tallymark.sources.ledger import TABLES, Ledger  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Some tests look into the list of what ran, which must not lose its head while they do.
        "spark.sql.ui.retainedExecutions": "50000",
        "spark.driver.memory": "3g",
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def no_broadcast(monkeypatch, conf):
    """What the plans do when nothing is small enough to broadcast."""
    from tallymark.operators import lookup, match

    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(lookup, "MAX_BROADCAST_BYTES", -1)
    monkeypatch.setattr(match, "MAX_BROADCAST_BYTES", -1)


@pytest.fixture
def large_ledger(monkeypatch):
    """Treat every transaction table as large, so that the ledger is narrowed first."""
    from tallymark.operators import lookup

    monkeypatch.setattr(lookup, "LARGE_TABLE_ROWS", 0)


# Types of the ledger's columns; a decimal is given as text.
ARROW = {"bigint": pa.int64(), "int": pa.int32(), "timestamp": pa.timestamp("us")}


def local_frame(spark, rows, types):
    """A small DataFrame that needs no Python worker to be read."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=pa.schema(types)))


DAY = datetime(2024, 5, 1, 10, 30)


def authorization(id, code, **values):
    """An authorization whose reference and acquirer code are both ``code``."""
    row = {
        "id": id,
        "codigo_referencia": code,
        "ref_id": "r1",
        "codigo_unico_adq": code,
        "fecha_hora_creacion": DAY,
        "exitosa": 1,
        "monto_autorizado": "10.50",
        "comercio_procesador_terminal_id": 1,
    }
    return {**row, **values}


@pytest.fixture
def interpreted(conf):
    """A few rows are read faster than code for them is generated."""
    conf(spark__sql__codegen__wholeStage="false", spark__sql__codegen__factoryMode="NO_CODEGEN")


@pytest.fixture
def make_ledger(spark, interpreted):
    """A ledger from lists of dicts; tables not given are those of one merchant with one terminal."""

    def make(**tables):
        rows = {
            "estado_transaccion": [{"id": 1, "nombre": "Pagado"}, {"id": 2, "nombre": ""}],
            "historial_transaccion": [{"id": 1, "estado_transaccion_id": 1}, {"id": 2, "estado_transaccion_id": 2}],
            "comercio": [{"id": 1, "nombre_comercial": "Tienda", "codigo_comercio": "T1"}],
            "comercio_procesador_terminal": [{"id": 1, "comercio_adquiriente_id": 1}],
            "comercio_adquiriente": [{"id": 1, "comercio_id": 1, "comercio_contrato_id": 1, "adquiriente_id": 4}],
            "comercio_contrato": [{"id": 1, "tipo_contrato_id": 1}],
            **tables,
        }

        def frame(name):
            columns = TABLES[name]
            types = {c: ARROW.get(t, pa.string()) for c, t in columns.items()}
            return local_frame(spark, rows.get(name, []), types)

        return Ledger.of({name: frame(name) for name in TABLES})

    return make


def transaction(authorization_id, history=1, merchant=1):
    return {
        "autorizacion_id": authorization_id,
        "historial_transaccion_actual_id": history,
        "comercio_id": merchant,
    }


@pytest.fixture
def make_lines(spark):
    """Numbered lines of a layout from dicts; columns not given are empty."""

    def make(layout, *rows):
        values = [{**dict.fromkeys(layout.columns, ""), **r, layout.line_id: i} for i, r in enumerate(rows, 1)]
        return local_frame(spark, values, {**dict.fromkeys(layout.columns, pa.string()), layout.line_id: pa.int64()})

    return make
