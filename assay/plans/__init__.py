"""Contracts: what reviewers decided, compiled and checked."""
