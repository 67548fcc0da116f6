"""Training-data operators (dedup, decontamination, scans, scoring, tokenising).

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need not have this
# package installed (only the libraries that it imports).
cloudpickle.register_pickle_by_value(sys.modules[__name__])
