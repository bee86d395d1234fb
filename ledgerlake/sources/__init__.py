"""Scans: ledger, master, staged batches, sheet exports, folders, HTML tables."""

from ledgerlake.sources.tables import (  # noqa: F401
    read_ledger, read_master, read_batch, to_staged, read_ranges, read_sheet_export, read_folder,
)
from ledgerlake.sources.html import read_html_tables, html_table_rows  # noqa: F401
from ledgerlake.sources.sniff import sniff_format  # noqa: F401
