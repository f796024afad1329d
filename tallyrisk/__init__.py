"""tallyrisk — receivables and counterparty-risk scoring on Spark.

Every public operator is a function ``DataFrame -> DataFrame`` built from
Spark SQL built-ins, so Catalyst can prune, push down and whole-stage
codegen the whole plan.  See README.md for the map of operators.
"""
__version__ = "0.1.0"
