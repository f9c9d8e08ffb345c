"""Plans: end-to-end runs, the versioned commit store, the query catalog and its oracles."""
