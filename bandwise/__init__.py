"""Similar vectors by random-hyperplane signatures and banding, on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from bandwise.durable import release
from bandwise.functions.cosine import angle_cosine, cosine
from bandwise.functions.simhash import hyperplanes, l2_norm, simhash, with_norm, with_simhash
from bandwise.operators.banding import band_keys, bucket_sizes
from bandwise.operators.pairs import candidate_count, candidate_pairs, with_cosine
from bandwise.plans.quality import quality_by_k, similar_docs_by_k
from bandwise.plans.report import growth_curves, largest_n, representative_k, scaling_exponent
from bandwise.plans.similar import similar_pairs
from bandwise.plans.sweep import run_sweep, sweep
from bandwise.sources.fvecs import read_fvecs, write_fvecs
from bandwise.sources.sinks import finished_sizes, read_quality, write_pairs, write_quality
from bandwise.sources.vectors import first_n, read_vectors

__all__ = [
    "angle_cosine",
    "band_keys",
    "bucket_sizes",
    "candidate_count",
    "candidate_pairs",
    "cosine",
    "finished_sizes",
    "first_n",
    "growth_curves",
    "hyperplanes",
    "l2_norm",
    "largest_n",
    "quality_by_k",
    "read_fvecs",
    "read_quality",
    "read_vectors",
    "release",
    "representative_k",
    "run_sweep",
    "scaling_exponent",
    "similar_docs_by_k",
    "similar_pairs",
    "simhash",
    "sweep",
    "with_cosine",
    "with_norm",
    "with_simhash",
    "write_fvecs",
    "write_pairs",
    "write_quality",
]
