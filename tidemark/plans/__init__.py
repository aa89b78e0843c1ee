"""Operators composed into jobs, marts and the registered queries."""
