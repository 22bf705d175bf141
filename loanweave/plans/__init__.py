"""Whole jobs over the loan tables: cleaning, verification, feature table, training."""
