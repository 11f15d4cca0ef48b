"""Plans: staging and marts, the query catalogue, the full run."""
