"""Landed pages in, versioned parquet tables out."""
