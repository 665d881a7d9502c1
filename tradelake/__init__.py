"""tradelake: a trade data lake written as Spark jobs."""
