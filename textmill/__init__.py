"""Spark jobs that turn raw text and chat records into training data."""

import sys

from pyspark import cloudpickle

# Worker functions travel with their code, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
