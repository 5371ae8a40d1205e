"""File sources and sinks: discovery, inventory, CSV scans, per-file caps, feature cache."""

from .files import (DECLARED_TYPES, canonical_name, discover_files, file_inventory, read_header,
                    row_cap_per_file, scan_flows, scan_headerless)

__all__ = ["DECLARED_TYPES", "canonical_name", "discover_files", "file_inventory", "read_header",
           "row_cap_per_file", "scan_flows", "scan_headerless"]
