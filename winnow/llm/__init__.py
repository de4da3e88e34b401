"""Operators of a training-data pipeline, each by one named method; ``queries`` registers one query for each.

Nothing outside this package imports it.  Executors import it by name, so ship it with the job as one would any
library (``--py-files`` or an environment).
"""
