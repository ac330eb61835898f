"""Training-data operators: text filtering, deduplication, scoring and mixing at corpus scale.

Functions that run inside Spark tasks are shipped by value, so executors need no copy of this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
