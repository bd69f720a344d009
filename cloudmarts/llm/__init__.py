"""Training-data operators: quality, PII, fingerprints, near-dedup, sharding, secrets,
decontamination, preference formatting, URL rules and sequence packing.  Nothing outside
this subpackage imports it.

Functions that run inside tasks travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
