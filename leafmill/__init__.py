"""leafmill: captured web pages in, records, coverage and crawl work tables out, all as Spark jobs."""
