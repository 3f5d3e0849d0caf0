"""Sources and sinks: declared schemas, checked reads, partitioned writes."""

from retail_marts.sources.tables import SCHEMAS, SchemaMismatch, column_totals, read_table, read_tables
from retail_marts.sources.sinks import remove_table, write_fact, write_table

__all__ = ["SCHEMAS", "SchemaMismatch", "column_totals", "read_table", "read_tables", "remove_table", "write_fact", "write_table"]
