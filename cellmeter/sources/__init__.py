"""Reading messages and writing results."""
