"""tidemark: social-text analytics on Spark DataFrames."""
