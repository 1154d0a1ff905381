"""Spark operators for a warehouse-picking lakehouse: clean, keep the latest, hash,
upsert, keep history, resolve point-in-time keys, check quality and measure."""
