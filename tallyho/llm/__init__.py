"""Training-data operators: one module per operator, see ``queries``.

Nothing else in the library imports this subpackage. Python code that runs in
tasks is pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

# The whole library: operators use helpers of its other parts.
cloudpickle.register_pickle_by_value(sys.modules["tallyho"])
