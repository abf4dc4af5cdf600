"""Operators for preparing text corpora: redaction, search, duplicate detection, formatting, scoring and mixing."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
