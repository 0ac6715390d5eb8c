"""Plans: the daily pipeline, the test scenario and the query registry."""
