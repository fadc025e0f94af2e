"""Plans: the end-to-end run, the registered queries and their SQL oracles."""
