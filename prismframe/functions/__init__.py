"""Column functions: text, URLs, dates, statistics, vectors, hashes."""
