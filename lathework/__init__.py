"""lathework: Spark-native curation and evaluation analytics for recorded agent sessions."""
