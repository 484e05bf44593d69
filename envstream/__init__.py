"""Environmental sensor streams on Spark: parsing, quality, windows, peaks, serving and tables."""
