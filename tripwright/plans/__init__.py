"""Staging and mart models, the end-to-end chain and the registered queries."""
