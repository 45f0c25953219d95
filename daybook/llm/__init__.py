"""Operators for preparing training text at corpus scale.

Nothing else in the library imports this package.  ``queries.py`` registers
one ``opN_<name>`` query per operator; each operator module has its own
general interface.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks that use them, so
# executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
