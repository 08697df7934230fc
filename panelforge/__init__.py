"""PySpark-native engine for market-data ingestion, quality control and feature panels."""
