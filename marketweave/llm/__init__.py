"""Operators of a training-data pipeline: cleaning, deduplication, decontamination, scoring and mixing of text."""

import sys

from pyspark import cloudpickle

# Workers get the functions with the task, wherever the package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
