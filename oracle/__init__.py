"""DuckDB SQL that states the expected result of every query independently of the Spark code."""
