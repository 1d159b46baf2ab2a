"""DuckDB SQL that the Spark results are compared with."""
