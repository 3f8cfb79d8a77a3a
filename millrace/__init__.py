"""Spark-native operators for policy, claims, contact and audience tables."""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its few Python helpers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
