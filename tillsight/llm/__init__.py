"""Training-data operators: tokens, deduplication, filtering, extraction, search.

Each module holds one operator; ``registry`` binds them to the test tables.
The functions of this package that run inside tasks are shipped with the task
itself, so executors do not need the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
