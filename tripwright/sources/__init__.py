"""Readers, table registration and versioned tables."""
