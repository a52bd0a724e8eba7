"""Column expressions shared by the readers and the reports."""
