"""Sources and sinks: sheet landing table, page links, stored tables."""

from arealens.sources.links import link_inventory, newest_link
from arealens.sources.sheets import (body_rows, header_rows, pick_sheets, read_sheet_rows,
                                     sheet_table, sheets_per_source)
from arealens.sources.tables import append_table, read_table

__all__ = ["link_inventory", "newest_link", "body_rows", "header_rows", "pick_sheets", "read_sheet_rows",
           "sheet_table", "sheets_per_source", "append_table", "read_table"]
