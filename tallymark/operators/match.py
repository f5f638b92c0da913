"""Matching statement lines with authorizations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import text_date
from tallymark.operators.grouping import distinct_keys
from tallymark.operators.prepare import nonempty
from tallymark.sources.layouts import Layout
from tallymark.sources.ledger import TABLES

# Order in which the least authorization of a group is chosen: its id, then whatever else distinguishes it.
AUTHORIZATION_ORDER = [
    "id",
    "fecha_hora_creacion",
    "monto_autorizado",
    "exitosa",
    "codigo_unico_adq",
    "codigo_referencia",
    "ref_id",
    "tarhab_email",
    "hash_tarjeta",
    "numero_tarjeta_enmascarada",
    "comercio_procesador_terminal_id",
]
assert set(AUTHORIZATION_ORDER) == set(TABLES["autorizacion"])

MAX_BROADCAST_BYTES = 128 << 20


def match_lines(lines: DataFrame, authorizations: DataFrame, layout: Layout) -> DataFrame:
    """Lines with a key, each with every authorization of the same code. Columns of both sides are kept."""
    a = authorizations.withColumnRenamed("id", "_authorization_id")
    return lines.filter(nonempty(layout.key)).join(a, F.col(layout.key) == F.col(layout.ledger_key))


def unmatched_lines(lines: DataFrame, authorizations: DataFrame, layout: Layout) -> DataFrame:
    """Lines with a key that no authorization has."""
    authorizations = authorizations.filter(nonempty(layout.ledger_key))
    codes = distinct_keys(authorizations, [layout.ledger_key], "id").withColumnRenamed(layout.ledger_key, "_code")
    return lines.filter(nonempty(layout.key)).join(codes, F.col(layout.key) == F.col("_code"), "left_anti")


def same_code_and_day(layout: Layout) -> Column:
    """Join condition of the day-matched layout. A text that is no date equals no day."""
    return (F.col(layout.key) == F.col("codigo_unico_adq")) & (text_date(F.col(layout.day)) == F.col("auth_day"))


def code_days(eligible: DataFrame) -> DataFrame:
    """Codes and days of eligible authorizations, for semi and anti joins."""
    return distinct_keys(eligible, ["codigo_unico_adq", "auth_day"], "id")


def matched_by_day(lines: DataFrame, eligible: DataFrame, layout: Layout) -> DataFrame:
    """Lines with an eligible authorization of the same code and day; each line once."""
    return lines.filter(nonempty(layout.key)).join(code_days(eligible), same_code_and_day(layout), "left_semi")


def unmatched_by_day(lines: DataFrame, eligible: DataFrame, layout: Layout) -> DataFrame:
    """All other lines: without a key, without such an authorization, or with an ineligible one only."""
    return lines.join(code_days(eligible), same_code_and_day(layout), "left_anti")
