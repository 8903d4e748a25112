"""Allow-list for table and column names that come from configuration."""

from __future__ import annotations

import re

# Fixed value: the accepted shape of a name.
SAFE_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_$.]*$")


def check_identifier(kind: str, value) -> str:
    if not isinstance(value, str) or not SAFE_NAME.fullmatch(value):
        raise ValueError(f"unsafe {kind}: {value!r}")
    return value
