"""Column-level building blocks; every one stays a Catalyst expression."""
