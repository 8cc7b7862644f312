"""Reading the logical tables, and writing results."""
