"""Company-page analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Tasks receive the few Python functions themselves, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
