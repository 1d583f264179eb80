"""Check suites written as YAML.

Supported lines, each under ``checks for <dataset>:``

- ``row_count between 1 and 9``
- ``missing_count(column) = 0``
- ``invalid_count(column) = 0:`` with ``valid min``, ``valid max`` or ``valid length``
- ``failed rows:`` with ``name`` and ``fail condition``
"""

from __future__ import annotations

import re

import yaml

from clearwell.operators.checks import (
    Check,
    InvalidCountZero,
    MissingCountZero,
    NoFailedRows,
    RowCountRule,
)

_ROW_COUNT = re.compile(r"row_count between (\d+) and (\d+)")
_COUNT_ZERO = re.compile(r"(missing|invalid)_count\((.+)\) = 0")
_RULES = {"valid min": "low", "valid max": "high", "valid length": "length"}


def load_suites(document: str) -> dict[str, list[Check]]:
    """Checks per dataset from the text of a YAML document."""
    sections = yaml.safe_load(document) or {}
    suites = {}
    for title, lines in sections.items():
        prefix, _, dataset = title.partition("checks for ")
        if prefix or not dataset:
            raise ValueError(f"not a check section: {title!r}")
        suites[dataset.strip()] = [_check(line) for line in lines]
    return suites


def _check(line: str | dict) -> Check:
    head, settings = next(iter(line.items())) if isinstance(line, dict) else (line, None)
    if head == "failed rows":
        return NoFailedRows(settings.get("name"), settings["fail condition"])
    if found := _ROW_COUNT.fullmatch(head):
        return RowCountRule(None, int(found[1]), int(found[2]))
    if found := _COUNT_ZERO.fullmatch(head):
        if found[1] == "missing":
            return MissingCountZero(found[2])
        unknown = set(settings or {}) - set(_RULES)
        if unknown or not settings:
            raise ValueError(f"{head}: expected some of {sorted(_RULES)}, found {sorted(unknown)}")
        return InvalidCountZero(found[2], **{_RULES[k]: v for k, v in settings.items()})
    raise ValueError(f"unsupported check: {head!r}")
