"""Scalar functions on columns: decoders and encoders of wire values, and text formatters."""
