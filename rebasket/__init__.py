"""Next-purchase features, training and scoring as Spark jobs."""
