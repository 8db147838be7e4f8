"""siltstone: document-corpus analytics on Spark DataFrames."""
