"""Incremental landing of page files in front of the contracted load."""
