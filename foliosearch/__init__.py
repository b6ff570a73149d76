"""Search and maintenance of large content tables, written as Spark jobs."""
