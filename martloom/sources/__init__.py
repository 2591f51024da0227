"""The nine source tables."""

from martloom.sources.tables import SOURCE_TABLES, catalog_tables, read_tables, with_tables
from martloom.sources.testdata import from_testdata

__all__ = ["SOURCE_TABLES", "catalog_tables", "from_testdata", "read_tables", "with_tables"]
