"""The commerce jobs, KPIs and reports."""
