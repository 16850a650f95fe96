"""Arabic text-authorship analytics expressed as Spark jobs.

Every function takes a ``DataFrame`` or ``Column`` (or a ``SparkSession`` to read
with) and returns one; none creates or stops a session.
"""
