"""Graph, PageRank and recommendation operators over DataFrames."""
