"""tablewright."""
