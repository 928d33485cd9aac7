"""Column expressions over URLs, text and hashes."""
