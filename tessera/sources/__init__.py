"""Sources: parquet tables, stand-in inputs, staged files and their readers."""
