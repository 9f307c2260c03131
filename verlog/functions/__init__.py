"""Scalar and seed-style column expressions."""
