"""Document-structure analytics on PySpark: words with layout in, blocks, outlines, links, indexes and tables out."""

__version__ = "0.1.0"
