"""Path-safe names for topics and transactions."""

import posixpath
import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_segment(name: Column) -> Column:
    """The last part of a path once . and .. are resolved; _ where none is left.

    .. at the start of a relative path stays in it, so that '../a' is a and '..' alone is _.
    """
    parts = F.filter(F.split(name, "/", -1), lambda p: (p != "") & (p != "."))
    rooted = name.startswith("/")

    def step(stack: Column, part: Column) -> Column:
        top = F.element_at(stack, -1)
        climbs = (F.size(stack) > 0) & (F.coalesce(top, F.lit("")) != "..")
        up = F.when(climbs, F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))).when(rooted, stack).otherwise(F.concat(stack, F.array(part)))
        return F.when(part == "..", up).otherwise(F.concat(stack, F.array(part)))

    left = F.aggregate(parts, F.array().cast("array<string>"), step)
    last = F.try_element_at(left, F.lit(-1))
    return F.when(last.isNull() | (last == ".."), F.lit("_")).otherwise(last)


def resolve_path(pattern: str, topic: Column, transaction: Column | None = None) -> Column:
    """The pattern with {txnID}, then {topic}, replaced by their safe segments, as the shortest path of the same meaning.

    A safe segment is one name, so the pattern can be shortened beforehand; one with a scheme is left as it is.
    """
    path = F.lit(pattern if "://" in pattern else re.sub("^//", "/", posixpath.normpath(pattern)))
    if transaction is not None:
        path = F.replace(path, F.lit("{txnID}"), safe_segment(transaction))
    return F.replace(path, F.lit("{topic}"), safe_segment(topic))
