"""Multi-step queries: PageRank and the id-cap profile."""
