"""Lead preparation on Spark: normalise, accept, merge, enrich, score, export.

Every operator is a plain ``DataFrame -> DataFrame`` function, made to be chained
with ``DataFrame.transform``.
"""
