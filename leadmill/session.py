"""Session settings the operators are made for."""

from __future__ import annotations

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins hash instead of sorting where every partition of the smaller side is seen to be
    # small at run time, as the row numbers of the anti join usually are.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # A bigger method is never compiled by the JVM; beyond this Spark uses several small ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}
