"""adlake: ad-reporting responses to typed lake tables, as Spark jobs."""
