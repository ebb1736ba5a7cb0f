"""pickwise: cheapest-candidate selection and selection-regret scoring on Spark."""

import sys as _sys

__version__ = "0.1.0"

# Functions of this package that run in Python workers (the Arrow fold
# solver) are shipped with the task by value, so executors need no install.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # pragma: no cover
    pass
