"""DataFrame operators; each is a function of DataFrames and parameters."""
