"""Operators on pixel-year tables: DataFrame in, DataFrame out."""
