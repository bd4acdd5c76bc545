"""blotter: incident-record analytics on Spark DataFrames.

Sub-packages: ``sources`` (readers, writers, test-table adapters),
``functions`` (column expressions), ``operators`` (DataFrame -> DataFrame
jobs), ``plans`` (multi-step jobs: dashboard slices, classifiers),
``streaming`` (incremental refresh of the rollup tables).
"""

__version__ = "0.1.0"
