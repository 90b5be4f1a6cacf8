"""corploom: a Spark-native engine for building and mining multilingual text corpora."""
