"""The batch stages: raw files to clean tables, star schema, signals, KPIs and reports."""
