"""Composite plans: ETL presets, training/scoring, ledger analysis, report."""
