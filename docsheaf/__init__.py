"""Document extraction on Spark: clean, chunk, call, parse, store and report.

Every operator is a ``Column -> Column`` or ``DataFrame -> DataFrame`` function.
"""

import sys

from pyspark import cloudpickle

# executors need no copy of the package: its functions travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
