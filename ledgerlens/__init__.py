"""Audit analytics for public-expenditure commitments, expressed as Spark jobs."""
