"""Operators for preparing training text, and their registered queries.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.  The
task functions are pickled by value, so executors need the third-party
libraries only, not this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
