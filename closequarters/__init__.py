"""closequarters: close-encounter analytics on moving-object position reports, Spark-native."""
from .params import DEFAULTS, Params

__all__ = ["DEFAULTS", "Params"]
