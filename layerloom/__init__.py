"""Layered-corpus analytics on Spark: observations, claims, a name ledger and text layers."""
