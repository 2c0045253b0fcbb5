"""Fraud scoring on Spark: tables, training, scoring, reconciliation and export."""
