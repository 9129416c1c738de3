"""sprout: Spark-native reflection-text labelling, cleaning, feature and scoring engine."""

__version__ = "0.1.0"
