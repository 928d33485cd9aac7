"""Cleaning, de-duplicating and labelling large tables of crawled articles."""
