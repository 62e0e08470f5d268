"""Operators of a training-data pipeline over ``documents``, ``pages``, ``embeddings`` and ``conversations``.

Nothing outside this subpackage imports it.  Functions that run on executors are pickled by value, so executors need
numpy, pyarrow and the tokenizer libraries, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
