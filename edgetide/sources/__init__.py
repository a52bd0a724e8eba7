"""Readers and writers: edge files, saved results, the graphs inside the test tables."""
