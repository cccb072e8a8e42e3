"""Wiki page dumps as Spark tables: clean text, links, dates, and link-date pairs."""
