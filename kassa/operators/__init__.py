"""DataFrame -> DataFrame jobs."""
