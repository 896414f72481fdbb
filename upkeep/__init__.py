"""Predictive maintenance on Spark.

Rows are (asset, day) records. Three jobs hand over through tables:

* matrix:   sensor readings + utilization + interruptions -> labelled rows
* training: labelled rows -> fitted decision-tree pipeline and its metrics
* scoring:  requested (asset, day) pairs -> one keyed verdict per pair

Every function takes and returns DataFrames and leaves planning to Catalyst.
"""
