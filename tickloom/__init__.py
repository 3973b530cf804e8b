"""Option-ticker, candle and training-corpus analytics as Spark DataFrame jobs."""
