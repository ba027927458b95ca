"""Analytics over scientific measurements mined from documents, expressed as Spark plans."""

__version__ = "0.1.0"
