"""Spark-native analytics for a seat-auction domain, with training-data operators in ``seatloom.llm``."""
