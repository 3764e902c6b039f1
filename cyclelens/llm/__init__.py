"""Operators for preparing language-model training data. Nothing else imports this package.

What runs in tasks is sent to the executors with its code, so the package need only be
installed where the driver runs. The libraries it uses must be on the executors.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
