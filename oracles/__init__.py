"""The registered queries written down independently in DuckDB SQL."""
