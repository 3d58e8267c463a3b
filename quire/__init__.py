"""quire: batch question answering over Spark tables.

Everything around the model call is plain DataFrame / Structured Streaming
work: resume and retry joins, last-wins logs, completeness fills, reply
parsing, candidate voting, caching, run comparison and reports. The model is
an injected responder that runs inside Spark tasks.
"""

import sys as _sys

from quire.session import get_session, checkpoint_dir

# Functions and responder classes used inside Spark tasks (mapInPandas,
# foreachBatch) are shipped by value, so executors need no installed copy of
# this package.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: rely on --py-files
    pass

__all__ = ["get_session", "checkpoint_dir"]
