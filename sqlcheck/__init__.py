"""DuckDB SQL that states each registered query directly over the test tables."""
