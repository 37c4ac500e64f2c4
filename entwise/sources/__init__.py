"""Readers: tables, CSV snapshots, control files and the driver-table adapters."""
