"""Registered queries, their oracles, and the end-to-end flows."""
