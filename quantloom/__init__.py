"""quantloom: a Spark-native engine for entity-by-day panels and their documents."""
