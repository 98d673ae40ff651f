"""Operational telemetry on Spark: landed provider pages to events, and series queries."""

import sys

from pyspark import cloudpickle

from tidegauge.session import config_table, configure, shared_dir

# Functions that run in tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["config_table", "configure", "shared_dir"]
