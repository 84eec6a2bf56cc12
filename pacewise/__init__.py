"""pacewise: ad-event lakehouse analytics on the Spark DataFrame / SQL / Structured Streaming APIs.

Layers: a raw ``bronze`` event table (duplicates, late and malformed rows kept), a deduplicated
``silver`` event fact plus a campaign dimension, and three ``gold`` products (impression delivery,
inventory fill, campaign pacing). Around them: analyst queries, data-quality checks, partition
layouts with pruning helpers, compaction, and user erasure across all layers.
"""

__all__ = ["session", "schemas", "constants"]
