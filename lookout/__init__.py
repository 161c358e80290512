"""lookout: a Spark-native image-classification stream and the analytics
around it (live views, dataset preparation, evaluation)."""

__version__ = "0.1.0"
