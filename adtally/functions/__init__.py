"""Scalar helpers, all native column expressions."""
