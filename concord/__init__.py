"""Reconciliation of large annotated tables on Spark."""
