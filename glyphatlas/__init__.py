"""glyphatlas: Spark jobs that turn tagged text records into typed tables, graphs, vectors and map data."""

__version__ = "0.1.0"
