"""Plans: silver and gold layers, the end-to-end pipeline, registered queries."""
