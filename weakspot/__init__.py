"""weakspot: labelled source-code datasets built, enriched and modelled on Spark."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so executors need no install
cloudpickle.register_pickle_by_value(sys.modules[__name__])
