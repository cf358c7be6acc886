"""A monthly trip pipeline for Spark: bronze, silver and quarantine, gold, release."""
