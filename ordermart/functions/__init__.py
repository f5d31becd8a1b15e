"""Fixed business values and reusable column expressions."""
