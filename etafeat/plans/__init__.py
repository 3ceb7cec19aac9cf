"""Plans: the pipeline stages and the named queries over the test tables."""
