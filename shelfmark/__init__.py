"""shelfmark: scraped product pages to clean, keyed catalogue tables, on Spark.

The package turns landed HTML into sixteen text fields, coerces them under a
chosen null policy, and loads them into keyed tables, in batch or as a stream.
Everything is DataFrame code; see ``README.md`` for the map of modules.
"""

import sys

from pyspark import cloudpickle

from shelfmark.schema import MISSING, RAW_FIELDS, RAW_SCHEMA
from shelfmark.session import build_session, scratch_dir

# The HTML step runs in Python workers, which need not have this package: its
# functions travel with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["MISSING", "RAW_FIELDS", "RAW_SCHEMA", "build_session", "scratch_dir"]
