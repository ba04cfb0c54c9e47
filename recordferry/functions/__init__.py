"""Column functions: comparison semantics and mapping rules."""
