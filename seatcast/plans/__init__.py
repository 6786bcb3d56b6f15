"""Whole jobs (``build``) and the query registry (``registry``)."""
