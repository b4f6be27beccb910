"""Record-to-mart analytics on Spark: JSON records in, checked tables out."""
