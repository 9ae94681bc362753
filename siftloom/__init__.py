"""Spark jobs that turn code-instruction tables into one clean training corpus."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions travel to the executors with their code, so the
# package itself is only needed where the jobs are defined.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
