"""Operators for training-data pipelines. Nothing outside this folder imports it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package by value, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
