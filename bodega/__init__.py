"""Spark-native retail analytics: bronze, silver and gold tables plus the reports that read them."""
