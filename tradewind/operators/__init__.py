"""Reusable DataFrame operators: joins, ranking, running values, dedup and labelled reports."""
