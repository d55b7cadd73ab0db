"""Trip analytics on PySpark: cleaning, marts, event pairing, versioned tables, retrieval."""
