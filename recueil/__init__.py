"""recueil: corpus preparation and similarity retrieval on Spark DataFrames.

The library turns landed JSON records into a clean, versioned corpus, attaches
embeddings, finds nearest neighbours for whole question tables and assembles
prompts and answers.  Everything is a lazy DataFrame plan unless a function is
documented to write or to measure something.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors do not need this package
# installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
