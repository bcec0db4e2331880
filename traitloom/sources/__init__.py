"""Readers and writers. Only this package deals with paths."""
