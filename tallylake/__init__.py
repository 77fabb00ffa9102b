"""Transaction analytics as Spark DataFrame operators."""

from tallylake.config import Config, DEFAULT

__all__ = ["Config", "DEFAULT"]
