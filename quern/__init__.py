"""quern: query-understanding analytics and text-corpus operators on Spark DataFrames."""
