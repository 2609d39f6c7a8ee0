"""Snapshot jobs that put the operators together."""
