"""Column expressions: keys, amounts and calendar arithmetic."""
