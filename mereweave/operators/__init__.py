"""DataFrame operators, by area."""
