"""tallyforge: a Spark-native engine for auditable document tallies."""
