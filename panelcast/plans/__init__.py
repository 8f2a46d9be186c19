"""Whole plans made of the operators: model table, model comparison, scoring."""
