"""Readers, writers and layer paths."""

from lakeproof.sources.paths import LakePaths
from lakeproof.sources.readers import (preview, read_catalog, read_layer, read_raw, read_reports,
                                       select_report)
from lakeproof.sources.writers import compact_reports, write_layer, write_report

__all__ = ["LakePaths", "compact_reports", "preview", "read_catalog", "read_layer", "read_raw", "read_reports",
           "select_report", "write_layer", "write_report"]
