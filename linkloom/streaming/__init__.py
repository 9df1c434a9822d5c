"""Streaming operators: each takes a streaming DataFrame and gives one, or a query that writes."""
