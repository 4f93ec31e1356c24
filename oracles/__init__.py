"""The registered queries once more as DuckDB SQL over the supplied tables."""
