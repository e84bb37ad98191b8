"""tessera: document concepts and recommendations as Spark DataFrame plans."""

__version__ = "0.1.0"
