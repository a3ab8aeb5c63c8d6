"""siftline: a Spark-native engine for web-threat datasets and text corpora."""
