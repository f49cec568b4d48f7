"""Stand-in inputs, registered queries and their oracle SQL."""
