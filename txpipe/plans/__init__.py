"""Named queries over the shared tables and their DuckDB oracle SQL."""
