"""ledgerlake: receivables-adjustment analytics written as Spark DataFrame jobs.

Sub-packages:
  functions  - column expressions (Oracle text/number/date rules, text cleaning, labels)
  sources    - scans of ledger, master, staged batches, sheets, HTML tables, folders
  operators  - posting, batch validation and load, reports, worklist clean-up, file naming
  plans      - test-table adapters, the query registry and its DuckDB oracle
  streaming  - incremental posting with Structured Streaming
"""

__version__ = "0.1.0"
