"""Column expressions built only from ``pyspark.sql.functions`` (JVM side,
inside whole-stage codegen; no Python UDF)."""

from mktlens.functions.scalars import *  # noqa: F401,F403
from mktlens.functions.predicates import *  # noqa: F401,F403
