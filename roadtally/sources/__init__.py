"""Readers and writers.  Readers give DataFrames; nothing is parsed on the driver."""
