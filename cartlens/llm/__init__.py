"""Operators for large training corpora (documents, embeddings, conversations).

Each operator is a function from DataFrames to a DataFrame with the real output
(texts, spans, paths, links).  ``queries.py`` derives the registered queries.
Nothing outside this subpackage and ``corpus_pipeline.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this subpackage with the job, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
