"""Query plans: presets, registered queries and their DuckDB oracles."""
