"""Python functions that run in tasks travel by value, so workers need not have the package installed."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ship_by_value(module_name: str) -> None:
    """Call at the end of a module whose functions run in Python workers."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
