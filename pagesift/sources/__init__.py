"""Reading crawl partitions, rule files and stage tables; writing stage tables."""
