"""tidewatch: alert lakehouse operators for Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function; see the
sub-packages ``sources``, ``functions``, ``operators``, ``plans``,
``streaming`` and ``lake``.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions run inside tasks travel with the job, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
