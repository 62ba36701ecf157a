"""Whole captures and the queries made of the operators."""
