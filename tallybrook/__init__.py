"""Commerce event streams on Spark: decode, enrich, land, count and publish.

Every operator takes a DataFrame and returns a DataFrame, and works unchanged on
batch and streaming input. Nothing here creates a session except ``tallybrook.app``.
"""
