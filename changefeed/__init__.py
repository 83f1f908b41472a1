"""Change-data-capture feeds on Spark: decode, validate, route and deliver."""

import sys

from pyspark import cloudpickle

from changefeed.session import configure

# The few Python functions used inside tasks travel with the plan, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["configure"]
