"""Sample quality control, read processing and run accounting as PySpark jobs."""

import sys

from pyspark import cloudpickle

from platewise.session import get_session

# functions that run in tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_session"]
