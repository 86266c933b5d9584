"""End-to-end jobs composed from operators, plus the query catalog."""
