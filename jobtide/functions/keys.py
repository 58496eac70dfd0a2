"""Hashed keys.  A NULL part gives a NULL key."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def job_identity(source: Column, external_id: Column) -> Column:
    """What the job key is the hash of."""
    return F.concat(source, F.lit(":"), external_id)


def job_key(source: Column, external_id: Column) -> Column:
    return F.md5(job_identity(source, external_id))


def mention_id(job_key: Column, skill: Column) -> Column:
    return F.md5(F.concat(job_key, F.lit("::"), skill))
