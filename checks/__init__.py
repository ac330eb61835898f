"""Driver checks: Spark query callables and their independent DuckDB SQL oracles."""
