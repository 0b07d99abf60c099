"""Row predicates: the relevance filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RELEVANCE


def relevant(spec: Iterable[tuple[str, str]] = RELEVANCE) -> Column:
    """Conjunction of case-insensitive equalities (``col ILIKE value``).

    Values carry no wildcards; NULL never matches and nothing is trimmed
    (``'Gas '`` does not match ``gas``)."""
    cond = None
    for col, value in spec:
        c = F.col(col).ilike(value)
        cond = c if cond is None else cond & c
    return F.lit(True) if cond is None else cond

