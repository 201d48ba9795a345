"""Sources: strict delimited extracts, shared-table bindings, file fingerprints."""
