"""Settlement reconciliation on Spark: statements matched with a ledger of payment authorizations."""

from tallymark.plans import mpos, pmc, transacciones
from tallymark.sources.layouts import LAYOUTS, MPOS, PMC, TRANSACCIONES, Layout, layout_for
from tallymark.sources.ledger import Ledger

__all__ = ["LAYOUTS", "Layout", "Ledger", "MPOS", "PMC", "TRANSACCIONES", "layout_for", "mpos", "pmc", "transacciones"]
