"""Recomputation as new edge files arrive."""
