"""Readers: CDC JSON landing, lake partitions and history, named sources,
and the stand-in adapters over the driver tables."""
