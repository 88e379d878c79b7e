"""muniment: the data work of a digital-repository migration, as Spark DataFrame operators."""

from muniment.model import RunOptions

__all__ = ["RunOptions"]
__version__ = "0.1.0"
