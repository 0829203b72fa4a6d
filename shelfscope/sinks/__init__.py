"""Sinks: table writes, idempotent day-partition replacement, write reports."""
