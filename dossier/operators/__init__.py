"""DataFrame operators: identity resolution, reconciliation, graph."""
