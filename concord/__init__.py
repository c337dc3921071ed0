"""Multi-source record conformance and answer-key reconciliation on Spark DataFrames."""
