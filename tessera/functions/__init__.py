"""Column-expression helpers (native Catalyst expressions only)."""
