"""Customer win-back analytics as Spark DataFrame operators."""

from regain.config import Settings

__all__ = ["Settings"]
