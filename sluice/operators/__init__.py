"""Relational operators: net change, keyed merge, key checks, reconciliation, ordering."""
