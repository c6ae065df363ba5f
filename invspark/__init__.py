"""Backup inventories and bulk-transfer analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver and no state is kept between calls.
"""

import sys

from pyspark import cloudpickle

# The few Python helpers travel with their tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
