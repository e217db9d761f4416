"""sparkloom: a PySpark-native engine for building clean text corpora."""

import os
import sys
from pathlib import Path


def _workers_can_import() -> bool:
    root = Path(__file__).resolve().parent.parent
    places = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
    return any(Path(p).resolve() == root for p in places)


if not _workers_can_import():
    # Python workers inherit PYTHONPATH and the working folder; where neither holds
    # this package, its functions travel by value.
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
