"""Compositions: staging, KPI queries and the full run."""
