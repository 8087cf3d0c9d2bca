"""Spark-native reconciliation of price offers and product barcodes."""
