"""Errors of a Spark action or statement, for batches that record them and go on."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A failed task comes as the plain Java error, all else as Spark's own classes.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


def message(problem: BaseException) -> str:
    if isinstance(problem, Py4JJavaError):
        return str(problem.java_exception)
    return str(problem)
