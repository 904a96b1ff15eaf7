"""Column-level building blocks: predicates, scalar functions and string similarity."""
