"""Parquet lake writers: partition replace and merge, snapshots, quarantine,
profiles, clustering, audit, catalog tables."""
