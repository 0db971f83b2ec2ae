"""Training-data operators (sharding, packing, filtering, dedup, scoring). Nothing else in caseload imports this.

Functions of this package that run in tasks travel by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
