"""Training-data operators: deduplication, decontamination, tokenisation, archives, privacy.

Nothing outside this folder imports it. Each module holds one operator; ``queries.py``
registers one query per operator and ``ORACLES`` its SQL where SQL can express it.
"""

import sys

from pyspark import cloudpickle

# Tasks get these modules' functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
