"""Python values as SQL literals.

Reports and merges are assembled as SQL expressions: a wide one then costs the
driver a single call into the JVM instead of several per column.
"""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal
from typing import Any


def sql_literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"
    if isinstance(value, Decimal):
        return f"{value:f}BD"
    if isinstance(value, datetime):
        kind = "TIMESTAMP_NTZ" if value.tzinfo is None else "TIMESTAMP_LTZ"
        return f"{kind} '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"cannot write {value!r} as a SQL literal")
