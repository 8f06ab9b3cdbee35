"""DuckDB SQL oracles for the registered queries (test-only, independent of
the Spark code path)."""
