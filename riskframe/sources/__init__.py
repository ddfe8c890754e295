"""Readers and writers: tables, delimited files, fitted models, run log."""
