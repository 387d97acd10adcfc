"""Table, vector and model readers and writers."""
