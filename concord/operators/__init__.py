"""Relational operators: conform, merge, judge, reconcile, overlap, score, findings, vintage, contracts."""
