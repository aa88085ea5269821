"""DuckDB SQL that states what every registered query must return."""
