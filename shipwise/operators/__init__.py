"""Distributed table operators; every function returns a lazy DataFrame."""
