"""Spark-native preparation of text and dialogue data for model training.

Every operator is a function ``DataFrame -> DataFrame`` or ``Column -> Column``.
"""

__version__ = "0.1.0"
