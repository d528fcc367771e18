"""Text cleaning rules and the hash bucket used for assignment and sampling.

The rules are SQL expressions over a column name.
"""

from __future__ import annotations

from trailmart.schemas import CATEGORY, UNKNOWN


def normalised(name: str) -> str:
    return f"lower(trim({name}))"


def empty_to_null(name: str) -> str:
    return f"nullif({name}, '')"


def known_or_unknown(name: str) -> str:
    return f"coalesce(nullif(trim({name}), ''), '{UNKNOWN}')"


def hash_bucket(key: str, buckets: int = 100) -> str:
    """A stable bucket in ``[0, buckets)`` from the leading 32 bits of the MD5 of ``key``.

    The same key gets the same bucket on every run, engine and partitioning.
    """
    return f"cast(cast(conv(substring(md5(cast({key} as string)), 1, 8), 16, 10) as bigint) % {buckets} as int)"


def time_or_null(name: str) -> str:
    """A timestamp from text that starts with a full date; anything less is NULL.

    A bare cast would read a time alone as today's and a year as its first of January.
    """
    return f"if({name} rlike '^ *[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}', try_cast({name} as timestamp), null)"


def whole_or_null(name: str) -> str:
    """A whole number from text; a fraction of zeros, as in 5.0, does no harm, any other does."""
    whole = f"try_cast(substring_index({name}, '.', 1) as bigint)"
    return f"coalesce(try_cast({name} as bigint), if({name} rlike '^ *[+-]?[0-9]+[.]0+ *$', {whole}, null))"


def category_or_null(name: str) -> str:
    """A category id from text, under the rule of ``whole_or_null``."""
    whole = f"try_cast(substring_index({name}, '.', 1) as {CATEGORY})"
    return f"if({name} rlike '^ *[+-]?[0-9]+([.]0+)? *$', {whole}, null)"
