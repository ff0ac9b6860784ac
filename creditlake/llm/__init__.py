"""Operations for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors with their code, so that a session needs no
# copy of the package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
