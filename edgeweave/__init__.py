"""edgeweave: analytics over large directed graphs held as Spark DataFrames of edges."""
