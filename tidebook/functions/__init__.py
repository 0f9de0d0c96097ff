"""Part of the market-data engine."""
