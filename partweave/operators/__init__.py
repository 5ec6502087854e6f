"""DataFrame operators: numbering, IDs, keys, binding, description, rollups."""
