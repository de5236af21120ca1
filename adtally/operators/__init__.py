"""Rollups, fraud analysis, reconciliation and merges: DataFrame in, DataFrame out."""
