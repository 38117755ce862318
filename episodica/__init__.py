"""Cohort and event-history analytics as Spark DataFrame jobs."""
