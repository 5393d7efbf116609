"""Cohort analytics as Spark jobs: survey responses, traits, variant quality, relatedness, association and scores."""

import sys

from pyspark import cloudpickle

# Small helpers that run inside tasks travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
