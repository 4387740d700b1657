"""Operators for preparing training text: filtering, deduplication, extraction, mixing, sharding.

Nothing outside this folder imports it except ``corpus_pipeline.py`` and the guarded
registration in ``__spark_entry__.py``. Functions of this package are sent to executors by
value, so these need not have it installed.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
