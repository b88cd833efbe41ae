"""Training-data operators: near-duplicates, language, sharding, URL lists,
secrets, benchmark leaks, exact search, language-model scores, byte-level BPE,
quality selection, nearest neighbours, spelling variants and Merkle manifests.
Nothing else in the library imports this package.

Its functions are pickled by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
