"""Analytics over governed data models, written as Spark DataFrame operators."""
