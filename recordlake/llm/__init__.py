"""Operators for preparing training text at scale; nothing else imports this."""

import sys

from pyspark import cloudpickle

# task functions travel with their code, so executors need no copy of the repo
cloudpickle.register_pickle_by_value(sys.modules[__name__])
