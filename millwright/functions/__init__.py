"""Column expressions used by the operators; none of them touches data."""
