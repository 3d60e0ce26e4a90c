"""Reading tables and landed payloads."""
