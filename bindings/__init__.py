"""The package applied to the test tables, with a DuckDB formulation beside every query."""
