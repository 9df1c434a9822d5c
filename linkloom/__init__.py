"""Page, search and session analytics written with Spark DataFrames."""
