"""Stages: each takes and returns DataFrames."""
