"""Training-data operators. Nothing else in the library imports this subpackage.

Functions that run in tasks are shipped by value, so executors need not have the
package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
