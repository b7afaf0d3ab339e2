"""Texts from templates with named fields, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{(\w+)(?::([^{}]*))?\}")
_FORMAT = re.compile(r"^(?:\.(\d+))?([f%d])?$")


def render(template: str, values: dict[str, Column]) -> Column:
    """``{name}``, ``{name:.2f}`` and ``{name:.0%}`` filled in; a template that names an unknown field or format comes back as it is.

    A null value is written as ``None``.
    """
    parts: list[Column] = []
    at = 0
    for m in _FIELD.finditer(template):
        name, spec = m.group(1), m.group(2) or ""
        shape = _FORMAT.match(spec)
        if name not in values or not shape:
            return F.lit(template)
        if m.start() > at:
            parts.append(F.lit(template[at : m.start()]))
        value, digits, kind = values[name], shape.group(1) or "0", shape.group(2)
        if kind == "%":
            text = F.concat(F.format_string(f"%.{digits}f", value.cast("double") * 100), F.lit("%"))
        elif kind == "f":
            text = F.format_string(f"%.{shape.group(1) or 6}f", value.cast("double"))
        else:
            text = value.cast("string")
        parts.append(F.coalesce(F.when(value.isNotNull(), text), F.lit("None")))
        at = m.end()
    if at < len(template):
        parts.append(F.lit(template[at:]))
    return F.concat(*parts) if parts else F.lit("")


def evaluation_id(claim: Column, timestamp: Column) -> Column:
    """``EVA-<day>-<8 hex digits>`` of a claim and an ISO time: equal inputs have equal ids."""
    day = F.replace(F.substring(timestamp, 1, 10), F.lit("-"), F.lit(""))
    return F.concat(F.lit("EVA-"), day, F.lit("-"), F.upper(F.substring(F.sha2(F.concat(claim.cast("string"), timestamp), 256), 1, 8)))


def data_uri(content: Column, kind: str = "image/png") -> Column:
    """Bytes as a data URI."""
    return F.concat(F.lit(f"data:{kind};base64,"), F.base64(content))
