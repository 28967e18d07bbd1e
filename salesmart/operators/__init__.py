"""Transforms: DataFrame in, DataFrame out, no action inside."""
