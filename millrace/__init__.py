"""millrace: data-processing operators expressed in Spark DataFrames."""
