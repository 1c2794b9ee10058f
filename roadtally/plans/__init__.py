"""Chains of operators: whole deliveries from raw rows to target tables."""
