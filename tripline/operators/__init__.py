"""Operators: DataFrame in, DataFrame out, no state and no actions."""
