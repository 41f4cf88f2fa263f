"""DataFrame operators: each takes and returns a DataFrame."""
