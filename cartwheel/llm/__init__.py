"""Training-data operators.  Nothing else in the library imports this subpackage.

Task functions are pickled by value, so executors need numpy, pyarrow and the
tokenizer libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
