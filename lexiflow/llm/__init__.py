"""Operators for preparing training data: quality, toxicity, duplicates,
tokenising, packing, search, host reputation and language-model scoring.

Nothing outside this subpackage imports it. Operators take and return
DataFrames; ``queries.py`` binds them to the driver's tables."""
