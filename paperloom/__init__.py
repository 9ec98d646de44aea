"""paperloom: scholarly-paper and patent linkage analytics as Spark DataFrame plans."""
