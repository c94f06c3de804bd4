"""Scalar rules as native Column expressions."""
