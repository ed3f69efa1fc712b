"""Column builders: features, rules and score bands. No DataFrame actions."""
