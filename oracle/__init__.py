"""DuckDB oracle SQL: the same results written as plain SQL over the raw test
tables (region, nation, customer, ... pre-registered as views)."""
