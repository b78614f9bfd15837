"""Profiling, transformation, conversion and validation as DataFrame operations."""
