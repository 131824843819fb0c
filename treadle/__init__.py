"""treadle: retail warehouse jobs written as Spark DataFrame plans."""

__version__ = "0.1.0"
