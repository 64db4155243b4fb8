"""Second-hand vehicle listings on Spark: extract, clean, profile, price."""
