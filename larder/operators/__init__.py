"""Relational operators of the crawl dataflow."""
