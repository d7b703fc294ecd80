"""Read-transform-write flows composed from the operators, and the registered queries."""
