"""Composed plans: the fused Silver plan, jobs, fixtures and registered queries."""
