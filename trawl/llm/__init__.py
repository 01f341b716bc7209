"""Operators of a training-data pipeline: secrets, chat formatting, quality
rules, language, near duplicates, toxicity, mixing, quality classifier, line
duplicates, benchmark decontamination, ranked search, Merkle manifest and BPE.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are shipped with the job (pickled by value), so executors need
no copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
