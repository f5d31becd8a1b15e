"""Layer operators: bronze, silver (clean), gold, marts, change application,
quality, fraud windows, features and rules."""
