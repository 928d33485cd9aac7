"""The test tables seen as a crawl, the query catalogue, and its SQL twin."""
