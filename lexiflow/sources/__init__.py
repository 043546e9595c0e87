"""Scans and sinks: driver tables, CoNLL-U, TEI, shared-task text formats."""
