"""Staging projections, marts, data tests and collection operators: DataFrame in, DataFrame out."""
