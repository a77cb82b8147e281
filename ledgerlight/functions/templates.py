"""Alert text templates with label placeholders.

``"{{ $labels.app }} in {{ $labels.namespace }}"`` is parsed once on the
driver into ``concat(lit, coalesce(col, ''), ...)``: a plain expression, no
UDF, evaluated inside codegen. A leading backslash (``\\{{``) is the escape of
the deployment templating and is dropped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_PLACEHOLDER = re.compile(r"\\?\{\{\s*\$labels\.([A-Za-z_][A-Za-z0-9_]*)\s*\}\}")


def template_parts(template: str) -> list[tuple[str, str]]:
    """Split into ``("text", s)`` and ``("label", name)`` parts."""
    parts: list[tuple[str, str]] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        if m.start() > pos:
            parts.append(("text", template[pos:m.start()]))
        parts.append(("label", m.group(1)))
        pos = m.end()
    if pos < len(template):
        parts.append(("text", template[pos:]))
    return parts


def render(template: str | None) -> Column:
    """Column expression rendering ``template`` against the row's label columns."""
    if template is None:
        return F.lit(None).cast("string")
    cols = [F.lit(v) if kind == "text" else F.coalesce(F.col(v).cast("string"), F.lit(""))
            for kind, v in template_parts(template)]
    if not cols:
        return F.lit("")
    return F.concat(*cols) if len(cols) > 1 else cols[0]


def render_from_map(template: str | None, labels: Column | str) -> Column:
    """Like :func:`render`, reading placeholders from a ``map<string,string>`` column."""
    m = F.col(labels) if isinstance(labels, str) else labels
    if template is None:
        return F.lit(None).cast("string")
    cols = [F.lit(v) if kind == "text" else F.coalesce(F.element_at(m, F.lit(v)), F.lit(""))
            for kind, v in template_parts(template)]
    if not cols:
        return F.lit("")
    return F.concat(*cols) if len(cols) > 1 else cols[0]


def labels_map(labels: list[str]) -> Column:
    """Label columns -> ``map<string,string>`` (keys sorted)."""
    pairs = []
    for k in sorted(labels):
        pairs += [F.lit(k), F.col(k).cast("string")]
    return F.create_map(*pairs)


def labels_text(labels: list[str]) -> Column:
    """Canonical label set text ``k1=v1,k2=v2`` with keys sorted."""
    return F.concat_ws(",", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("")))
                              for k in sorted(labels)])
