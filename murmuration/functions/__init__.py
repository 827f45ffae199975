"""Column functions: text measures, event time, wire formats."""
