"""Captured court-portal pages to tables, as Spark jobs."""
