"""Table bindings, shared storage and the query registry."""
