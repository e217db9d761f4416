"""Scalar functions: columns, Arrow functions, HTML."""
