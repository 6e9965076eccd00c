"""Compositions of operators: feature blocks, master tables and reports."""
