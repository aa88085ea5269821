"""Plans: operators put together into layer builds, training runs and named queries."""
