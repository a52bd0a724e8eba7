"""Operators over edge and rank DataFrames."""
