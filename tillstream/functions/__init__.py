"""Column functions: lenient JSON fields, event times, text formats."""
