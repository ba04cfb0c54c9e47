"""Readers, writers and the data bindings used by the registered queries."""
