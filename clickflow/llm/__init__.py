"""Operators for training-data pipelines over the tables ``documents``, ``embeddings`` and ``conversations``.

Nothing else in the library imports this subpackage. Its task functions are pickled by value, so executors need
numpy, pyarrow and the tokenizer libraries, but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
