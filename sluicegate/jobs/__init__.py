"""``spark-submit`` mains."""
