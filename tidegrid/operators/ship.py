"""Python functions that run on executors."""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def by_value(*modules: str) -> None:
    """The modules' functions go to executors as they are, so that executors need not have the package installed."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])
