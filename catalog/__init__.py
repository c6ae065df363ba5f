"""Registered queries over the given tables, one per operator."""

import sys

from pyspark import cloudpickle

from . import base

cloudpickle.register_pickle_by_value(sys.modules[__name__])

from . import archives, inventory, planning, scalars, progress, telemetry, verification  # noqa: E402,F401


def queries():
    return {name: base.runnable(entry) for name, entry in sorted(base.REGISTRY.items())}


def oracle_sql():
    return {name: base.full_sql(entry) for name, entry in sorted(base.REGISTRY.items()) if entry.body}
