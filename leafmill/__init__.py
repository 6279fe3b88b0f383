"""leafmill: a PySpark engine that turns documentation pages into a knowledge base."""

__version__ = "0.1.0"
