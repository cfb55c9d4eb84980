"""Operators that prepare text corpora for training, and their queries.

Task functions of this subpackage travel to the executors by value, so executors need only the
public libraries (numpy, pyarrow, regex, xxhash), not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
