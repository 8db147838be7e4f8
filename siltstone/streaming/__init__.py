"""Streams with keyed state: the incremental crawl."""
