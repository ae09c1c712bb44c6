"""caseload: incident-level public-safety analytics as Spark DataFrame jobs."""
