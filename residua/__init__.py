"""Spark-native preparation of sequence corpora for masked-language-model training."""

__version__ = "0.1.0"
