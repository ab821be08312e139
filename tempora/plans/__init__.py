"""Compositions of operators: cleaning, feature tables, the training table, the whole forecast run."""
