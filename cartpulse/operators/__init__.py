"""Rollups, insight views, business questions and checks: DataFrame in, DataFrame out."""
