"""sluice — Spark-native intake of messy business files and tables.

Entry points live in :mod:`sluice.plans` (text, CSV, spreadsheet and table-copy intake),
building blocks in :mod:`sluice.sources`, :mod:`sluice.operators`, :mod:`sluice.functions`
and :mod:`sluice.sinks`, incremental folder intake in :mod:`sluice.streaming`.
"""

__version__ = "0.1.0"
