"""Web-domain risk analytics expressed as lazy Spark plans."""

__version__ = "0.1.0"
