"""DuckDB SQL used to check the Spark results independently."""
