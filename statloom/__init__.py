"""PySpark toolkit for reading, reshaping, reconciling and watching published statistical tables."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the plan, so that neither executors nor the
# helper processes Spark starts on the driver need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
