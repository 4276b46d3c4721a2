"""Incremental processing of newly arrived archives."""
