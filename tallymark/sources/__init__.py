"""Inputs: statement files, ledger tables, and tables written between steps."""
