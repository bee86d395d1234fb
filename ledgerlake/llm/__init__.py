"""Training-data operators: ten operators on documents, pages and vectors, and their queries.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped with the task, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
