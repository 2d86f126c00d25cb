"""Web-corpus and link-graph analytics on Spark."""
