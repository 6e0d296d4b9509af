"""loomspan: Spark-first analytics over web pages, URL inventories, crawl and job records."""

__version__ = "0.1.0"
