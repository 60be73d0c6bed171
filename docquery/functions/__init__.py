"""Scalar functions: Column in, Column out, all built in; no user-defined functions."""
