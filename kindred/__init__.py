"""kindred: related-article search and the analytics around it, as PySpark DataFrame jobs."""
