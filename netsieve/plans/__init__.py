"""Plans: the query catalog (one entry per operator) and the configured training run."""
