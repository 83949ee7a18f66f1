"""Feed schema, landed documents and tables."""
