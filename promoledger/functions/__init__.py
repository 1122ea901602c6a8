"""Column helpers and row predicates."""
