"""Operators over block, issue, term and reference tables: DataFrame in, DataFrame out."""
