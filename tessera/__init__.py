"""Tessera: tile-grid, graph, versioned-asset and corpus analytics on Spark DataFrames."""
