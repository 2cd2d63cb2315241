"""Spark-native ingestion and analytics for marketplace sales exports whose layout drifts."""
