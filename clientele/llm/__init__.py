"""Operators for preparing training text at scale.

Ten operators over ``documents`` (doc_id, text, ...): licence scans, fuzzy line
dedup, sharding, benchmark decontamination, piece encoding, token counts, long
repeat removal, near-duplicate documents, language identification and quality
rules.  Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value, so a cluster
# needs no copy of the library on its nodes.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
