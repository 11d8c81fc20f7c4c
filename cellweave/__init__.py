"""cellweave: spatiotemporal cubes on Spark DataFrames."""
