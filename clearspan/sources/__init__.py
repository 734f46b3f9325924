"""Readers and writers: clearing files, ledgers, rates, tables, reports."""
