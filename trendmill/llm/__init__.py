"""Operators for preparing training text. Nothing outside this package imports it but the entry file.

Functions that run in Python workers travel with their tasks, so executors need numpy, pyarrow and
the tokenizer libraries, but not this package.
"""

from pyspark import cloudpickle

import trendmill

cloudpickle.register_pickle_by_value(trendmill)
