"""End-to-end jobs (ETL, KPI batch, fare model) and the query catalog."""
