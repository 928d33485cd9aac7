"""The daily runs: duplicates, labels, articles, and backfill over many days."""
