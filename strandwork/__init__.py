"""strandwork: Spark-native analytics over sequence-read data and search-hit tables."""
