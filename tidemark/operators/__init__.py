"""DataFrame operators: increments, changes, merges, schemas, specs, state, reports."""
