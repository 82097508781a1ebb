"""Text embedding, keyed vector tables and vector search as Spark jobs."""

from pyspark import cloudpickle

from vecloom.functions import kernels, models

# Task-side code travels with the job, so executors need no install of this package.
cloudpickle.register_pickle_by_value(kernels)
cloudpickle.register_pickle_by_value(models)
