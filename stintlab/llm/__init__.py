"""Operators for preparing training data, each over whole tables of any size.

Tasks get the operators' code with their work, so that Python workers need not have this
package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
