"""Label and marker lookups with defaults (map literal + element_at)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions.text import _c, capitalize


def _map(d: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(d.items())])


def lookup(col, mapping: dict, default) -> Column:
    """``mapping.get(code, default)``; ``default`` may be a Column."""
    d = default if isinstance(default, Column) else F.lit(default)
    c = _c(col)
    return F.coalesce(F.when(c.isNotNull(), F.element_at(_map(mapping), c)), d)


def category_label(col) -> Column:
    """Display label; unknown code is capitalised."""
    return lookup(col, vocab.CATEGORY_LABELS, capitalize(col))


def category_label_raw(col) -> Column:
    """Label as in the report's top section: unknown code shown as is."""
    return lookup(col, vocab.CATEGORY_LABELS, _c(col))


def category_marker(col) -> Column:
    return lookup(col, vocab.CATEGORY_MARKERS, vocab.DEFAULT_CATEGORY_MARKER)


def report_severity_marker(col) -> Column:
    return lookup(col, vocab.REPORT_SEVERITY_MARKERS, vocab.REPORT_DEFAULT_SEVERITY_MARKER)


def message_severity_marker(col) -> Column:
    return lookup(col, vocab.MESSAGE_SEVERITY_MARKERS, vocab.MESSAGE_DEFAULT_SEVERITY_MARKER)
