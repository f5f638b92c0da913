"""Lookups from an authorization to its transaction, state, merchant, tier, terminal and response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import CORE, product_tier
from tallymark.operators.grouping import distinct_keys, first_per_group, salted_lookup
from tallymark.sources.layouts import TIER
from tallymark.sources.ledger import Ledger
from tallymark.sources.scratch import write_packed

# The ledger's codes for the flag, the acquirer and the contract type.
LEDGER_FLAG = 11
ACQUIRER = 4
CONTRACT_TYPE = 1
MAX_BROADCAST_BYTES = 128 << 20
ID_BYTES = 32
# From this size on a table is worth a pass that keeps only the rows a small statement needs.
LARGE_TABLE_ROWS = 20_000_000


def flagged_merchants(comercio_configuracion: DataFrame) -> DataFrame:
    """Merchants with the ledger flag; the constant is filtered before the join, so other flags keep no merchant out."""
    rows = comercio_configuracion.filter((F.col("configuracion_id") == LEDGER_FLAG) & F.col("id").isNotNull())
    return rows.select(F.col("comercio_id").alias("_flag_merchant")).distinct().withColumn("_flagged", F.lit(True))


def migrated_merchants(whitemarches: DataFrame) -> DataFrame:
    """Merchant codes with a migration date."""
    rows = whitemarches.filter(F.col("migration_date").isNotNull())
    return rows.select(F.col("codigo_comercio").alias("_migrated_code")).distinct().withColumn("_migrated", F.lit(True))


def merchants(ledger: Ledger) -> DataFrame:
    """One row per merchant with its name and product tier.

    The three tables are joined here once, so that authorizations need a single join. The join on the code comes
    last: the merchants are then not partitioned by id, and the join on the id gets a shuffle of its own, which lets
    adaptive execution split the transactions of a hot merchant.
    """
    c = ledger.comercio
    flagged = flagged_merchants(ledger.comercio_configuracion)
    migrated = migrated_merchants(ledger.whitemarches)
    return (
        c.join(flagged, c["id"] == flagged["_flag_merchant"], "left")
        .join(migrated, c["codigo_comercio"] == migrated["_migrated_code"], "left")
        .select(
            F.col("id").alias("_merchant"),
            "nombre_comercial",
            product_tier(F.col("_migrated"), F.col("_flagged")).alias(TIER),
        )
    )


def _transactions(ledger: Ledger) -> DataFrame:
    return ledger.transaccion.select(
        F.col("autorizacion_id").alias("_authorization"),
        F.col("historial_transaccion_actual_id").alias("_history"),
        "comercio_id",
    )


def with_transactions(authorizations: DataFrame, ledger: Ledger) -> DataFrame:
    """Add the history id and merchant id of each authorization's least transaction."""
    t = first_per_group(_transactions(ledger), ["_authorization"], ["_history", "comercio_id"])
    return authorizations.join(t, F.col("id") == F.col("_authorization"), "left").drop("_authorization")


def with_all_transactions(authorizations: DataFrame, ledger: Ledger) -> DataFrame:
    """Add the history id and merchant id of every transaction; an authorization without one stays, with NULLs.

    The inner and the anti join together are the left join, but adaptive execution can split an authorization with
    very many transactions only in an inner join.
    """
    t = _transactions(ledger)
    found = authorizations.join(t, F.col("id") == F.col("_authorization")).drop("_authorization")
    known = distinct_keys(t.filter("_authorization is not null"), ["_authorization"], "_history")
    others = authorizations.join(known, F.col("id") == F.col("_authorization"), "left_anti")
    return found.unionByName(others, allowMissingColumns=True)


def with_states(transactions: DataFrame, ledger: Ledger) -> DataFrame:
    """Add the current state's name as ``nombre_estado``."""
    h = ledger.historial_transaccion.select(F.col("id").alias("_history_id"), "estado_transaccion_id")
    s = ledger.estado_transaccion.select(F.col("id").alias("_state_id"), F.col("nombre").alias("nombre_estado"))
    states = h.join(s, F.col("estado_transaccion_id") == F.col("_state_id"), "left").select("_history_id", "nombre_estado")
    return transactions.join(states, F.col("_history") == F.col("_history_id"), "left").drop("_history_id")


def with_merchants(transactions: DataFrame, ledger: Ledger) -> DataFrame:
    """Add the merchant's id, name and tier; a row without a merchant is in the core tier."""
    m = merchants(ledger)
    if ledger.merchant_bytes <= MAX_BROADCAST_BYTES:
        m = F.broadcast(m)
    joined = transactions.join(m, F.col("comercio_id") == F.col("_merchant"), "left")
    return joined.drop("comercio_id").withColumnRenamed("_merchant", "comercio_id").fillna({TIER: CORE})


def with_signatures(authorizations: DataFrame, ledger: Ledger) -> DataFrame:
    """Add the acquirer's signature to failed authorizations. Successful ones stay, with a NULL signature."""
    r = ledger.adq_vdp_v3_authorization.select(F.col("autorizacion_id").alias("_authorization"), "signature")
    r = first_per_group(r, ["_authorization"], ["signature"])
    on = (F.col("id") == F.col("_authorization")) & (F.col("exitosa") == 0)
    return authorizations.join(r, on, "left").drop("_authorization")


def enrich(authorizations: DataFrame, ledger: Ledger, *, by_id: bool = False) -> DataFrame:
    """The whole lookup chain; the number of authorizations does not change.

    ``by_id`` walks it with ids alone and joins the authorizations once with what was found: for many of them, whose wide
    rows would else be shuffled by transaction, state and merchant.
    """
    if by_id:
        ids = authorizations.select("id").distinct()
        found = enrich(ids, ledger).withColumnRenamed("id", "_found")
        return authorizations.join(found, F.col("id") == F.col("_found"), "left").drop("_found").fillna({TIER: CORE})
    return with_merchants(with_states(with_transactions(authorizations, ledger), ledger), ledger)


def referenced(table: DataFrame, key: str, rows: DataFrame, reference: str) -> DataFrame:
    """The rows of a table that ``rows``, a written table, refers to; the whole table if those are too many to broadcast."""
    if rows.count() * ID_BYTES > MAX_BROADCAST_BYTES:
        return table
    ids = rows.select(F.col(reference).alias("_reference")).distinct()
    return table.join(F.broadcast(ids), F.col(key) == F.col("_reference"), "left_semi")


def narrow_ledger(ledger: Ledger, authorizations: DataFrame) -> tuple[DataFrame, Ledger]:
    """Before the lookups of few authorizations in large tables: write them, and filter the tables while they are scanned.

    Without this a statement of a thousand lines would shuffle every transaction ever made. Small tables stay as they
    are, and so does a ledger of which too much is needed.
    """
    if ledger.transaction_count < LARGE_TABLE_ROWS:
        return authorizations, ledger
    authorizations = write_packed(authorizations, "authorizations")
    if authorizations.count() * ID_BYTES > MAX_BROADCAST_BYTES:
        return authorizations, ledger.with_tables()
    transactions = write_packed(
        referenced(ledger.transaccion, "autorizacion_id", authorizations, "id"), "transactions"
    )
    return authorizations, ledger.with_tables(
        transaccion=transactions,
        historial_transaccion=referenced(
            ledger.historial_transaccion, "id", transactions, "historial_transaccion_actual_id"
        ),
        adq_vdp_v3_authorization=referenced(
            ledger.adq_vdp_v3_authorization, "autorizacion_id", authorizations, "id"
        ),
    )


def eligible_terminals(ledger: Ledger) -> DataFrame:
    """Terminals that lead to the acquirer and contract type of the day-matched layout."""
    ca = ledger.comercio_adquiriente.filter(F.col("adquiriente_id") == ACQUIRER).select(
        F.col("id").alias("_acquirer_link"), "comercio_contrato_id"
    )
    cc = ledger.comercio_contrato.filter(F.col("tipo_contrato_id") == CONTRACT_TYPE).select(F.col("id").alias("_contract"))
    links = ca.join(cc, F.col("comercio_contrato_id") == F.col("_contract"), "left_semi").select("_acquirer_link")
    cpt = ledger.comercio_procesador_terminal
    return cpt.join(links, F.col("comercio_adquiriente_id") == F.col("_acquirer_link"), "left_semi").select(
        F.col("id").alias("_terminal")
    )


def eligible_authorizations(authorizations: DataFrame, ledger: Ledger) -> DataFrame:
    """Authorizations with a code and an eligible terminal, and the day they were made."""
    a = authorizations.filter(F.col("codigo_unico_adq") != "")
    a = a.join(eligible_terminals(ledger), F.col("comercio_procesador_terminal_id") == F.col("_terminal"), "left_semi")
    return a.withColumn("auth_day", F.to_date("fecha_hora_creacion"))


def acquirer_links(comercio_adquiriente: DataFrame) -> DataFrame:
    """Number of acquirer links per merchant: all that remains of a one-to-many join whose columns nobody reads."""
    return comercio_adquiriente.groupBy(F.col("comercio_id").alias("_linked")).agg(F.count(F.lit(1)).alias("_links"))


def with_links(transactions: DataFrame, ledger: Ledger) -> DataFrame:
    """Add the number of rows the join with the merchant's acquirer links makes of a row: at least one, as it keeps the row."""
    links = acquirer_links(ledger.comercio_adquiriente).join(ledger.comercio, F.col("_linked") == F.col("id"), "left_semi")
    if ledger.merchant_bytes <= MAX_BROADCAST_BYTES:
        linked = transactions.join(F.broadcast(links), F.col("comercio_id") == F.col("_linked"), "left")
    else:
        linked = salted_lookup(transactions, links, "comercio_id", "_linked", spread_by="id")
    return linked.drop("_linked").withColumn("_links", F.coalesce("_links", F.lit(1)))
