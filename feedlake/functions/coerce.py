"""Validation of scoring answers: allow-lists, clamps, JSON coercions.

Coercions follow Python semantics of the original mapper (``int(x)``,
``bool(x)``, ``str(x).strip()``) evaluated on VARIANT values.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions.text import _c, strip_ws

# fixed values: original French codes and the English codes they map to
_SEVERITY_FR = dict(zip(vocab.SEVERITIES_FR, vocab.SEVERITIES))
_CATEGORY_FR = dict(zip(vocab.CATEGORIES_FR, vocab.CATEGORIES))


def _translate(c: Column, mapping: dict) -> Column:
    expr = c
    for fr, en in mapping.items():
        if fr != en:
            expr = F.when(c == F.lit(fr), F.lit(en)).otherwise(expr)
    return expr


def allow_severity(col) -> Column:
    """Severity code in the vocabulary, else ``ignore``."""
    c = _translate(_c(col), _SEVERITY_FR)
    return F.when(c.isin(*vocab.SEVERITIES), c).otherwise(F.lit(vocab.DEFAULT_SEVERITY))


def allow_category(col) -> Column:
    """Category code in the vocabulary, else ``general``."""
    c = _translate(_c(col), _CATEGORY_FR)
    return F.when(c.isin(*vocab.CATEGORIES), c).otherwise(F.lit(vocab.DEFAULT_CATEGORY))


def severity_rank(col) -> Column:
    """Sort rank of a severity: critical 0 .. ignore 3; unknown 3."""
    c = _c(col)
    expr = F.lit(3)
    for i, s in reversed(list(enumerate(vocab.SEVERITIES))):
        expr = F.when(c == F.lit(s), F.lit(i)).otherwise(expr)
    return expr


def clamp_score(col) -> Column:
    """Clamp to 1..10; NULL counts as 1 (coalesce first: least/greatest skip NULLs)."""
    return F.greatest(F.lit(1), F.least(F.lit(10), F.coalesce(_c(col), F.lit(1))))


def _vtype(v: Column) -> Column:
    return F.schema_of_variant(v)


def variant_field(doc, path: str) -> Column:
    return F.try_variant_get(_c(doc), path, "variant")


def score_of(v, t=None) -> Column:
    """``int(x)`` then clamp, default 1 on failure (bool counts as 0/1).

    ``t`` may be a column already holding ``schema_of_variant(v)``.
    """
    v = _c(v)
    t = _vtype(v) if t is None else _c(t)
    as_text = F.try_variant_get(v, "$", "string")
    numeric = t.rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$")
    num_val = F.try_variant_get(v, "$", "double")
    finite = ~F.isnan(num_val) & (F.abs(num_val) < F.lit(float("inf")))
    from_num = F.when(finite, F.greatest(F.lit(-1e12), F.least(F.lit(1e12), num_val))
                      .cast("bigint"))
    txt = strip_ws(as_text)
    from_str = F.when(txt.rlike(r"^[+-]?[0-9]+$"),
                      F.when(F.length(txt) > 15,
                             F.when(txt.startswith("-"), F.lit(-1)).otherwise(F.lit(11)))
                      .otherwise(txt.cast("bigint")))
    from_bool = F.when(F.try_variant_get(v, "$", "boolean"), F.lit(1)).otherwise(F.lit(0))
    raw = (F.when(v.isNull() | (t == F.lit("VOID")), F.lit(None).cast("bigint"))
           .when(numeric, from_num)
           .when(t == F.lit("STRING"), from_str)
           .when(t == F.lit("BOOLEAN"), from_bool))
    return clamp_score(raw).cast("int")


def truthy(v, t=None) -> Column:
    """Python ``bool(x)`` of a JSON value; absent or null is False.

    A string is true when non-empty, so the text "false" is true.
    """
    v = _c(v)
    t = _vtype(v) if t is None else _c(t)
    return (F.when(v.isNull() | (t == F.lit("VOID")), F.lit(False))
            .when(t == F.lit("BOOLEAN"), F.try_variant_get(v, "$", "boolean"))
            .when(t == F.lit("STRING"), F.length(F.try_variant_get(v, "$", "string")) > 0)
            .when(t.startswith("ARRAY"), F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
            .when(t.startswith("OBJECT"), t != F.lit("OBJECT<>"))
            .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != F.lit(0.0),
                                  F.lit(True))))


def text_of(v, default: str = "", t=None) -> Column:
    """``str(x).strip()`` of a JSON value; NULL/absent gives ``default``."""
    v = _c(v)
    t = _vtype(v) if t is None else _c(t)
    return (F.when(v.isNull() | (t == F.lit("VOID")), F.lit(default))
            .when(t == F.lit("STRING"), strip_ws(F.try_variant_get(v, "$", "string")))
            .when(t == F.lit("BOOLEAN"),
                  F.when(F.try_variant_get(v, "$", "boolean"), F.lit("True"))
                  .otherwise(F.lit("False")))
            .otherwise(F.to_json(v)))


def raw_text_of(v, default: str = "") -> Column:
    """Text of a JSON value compared against codes or hashes, verbatim.

    Only JSON strings can equal a code or a hash, so any other value may map
    to its cast text (or the default) without changing a comparison.
    """
    return F.coalesce(F.try_variant_get(_c(v), "$", "string"), F.lit(default))
