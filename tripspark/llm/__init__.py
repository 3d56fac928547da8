"""Operators for a training-data pipeline (deduplication, archives, search, mixing, tokens, licences,
language ID, chat formatting, tokenisation), each a function from DataFrames to DataFrames.

Task functions are pickled by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
