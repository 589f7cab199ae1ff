"""Column expressions: vectors as ``array<double>``, text, keys."""
