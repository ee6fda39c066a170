"""The SQL that checks each query, assembled from ``oracle/*.sql``."""

from __future__ import annotations

import re
from pathlib import Path

_ORACLE = Path(__file__).parent / "oracle"
_SECTION = re.compile(r"^-- name: (\w+(?: \w+)*)\s*$", re.MULTILINE)


def oracle_sql() -> dict[str, str]:
    prefix = "WITH " + ",\n".join(
        (_ORACLE / name).read_text(encoding="utf-8").strip() for name in ("fixtures.sql", "layers.sql")
    )
    found = {}
    for file in ("statements.sql", "whole_sources.sql"):
        parts = _SECTION.split((_ORACLE / file).read_text(encoding="utf-8"))
        found |= {name: f"{prefix}\n{body.strip()}" for names, body in zip(parts[1::2], parts[2::2], strict=True) for name in names.split()}
    return found
