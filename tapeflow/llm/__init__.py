"""Operators for building training corpora: filtering, matching, mixing, scoring, formats.

Nothing else in the library imports this subpackage.  Its functions are sent to the
executors by value, so a cluster needs numpy and pyarrow (for language-model scoring tiktoken as
well) but no installed copy of it.  Broadcasts of own classes go through ``packed``.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def packed(value) -> bytes:
    """``value`` with its classes by value, for a broadcast; ``pickle.loads`` opens it.

    A broadcast is pickled by reference and would look for the package on the workers.
    """
    return cloudpickle.dumps(value)
