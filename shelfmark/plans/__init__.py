"""Analytic queries, the normalised variant and the end-to-end runs."""
