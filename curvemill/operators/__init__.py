"""DataFrame operators: shaping, lookups, curves, scenarios and checks."""
