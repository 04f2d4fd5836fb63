"""Column expressions: all native, so they stay inside whole-stage code generation."""
