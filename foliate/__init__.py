"""foliate: document-corpus analytics expressed as Spark DataFrames."""
