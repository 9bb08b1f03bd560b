"""framesift: image-sequence dataset analytics as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame``.  Tables and their
schemas are listed in :mod:`framesift.schemas`; the ready-made queries over the
driver tables live in :mod:`framesift.catalog`.
"""

import sys

from pyspark import cloudpickle

# The few Python helpers that run inside tasks travel with the plan, so that
# executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
