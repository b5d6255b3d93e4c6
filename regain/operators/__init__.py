"""Operators: plain ``DataFrame -> DataFrame`` functions, one module per subject."""
