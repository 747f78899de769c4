"""Cells of delimited lines, and whether a line ends inside a quoted cell.

A cell is quoted if a quote is its first character other than blanks; two quotes inside it are
one.  Text after the closing quote belongs to the cell.  Blanks around unquoted cells do not.
"""

from __future__ import annotations

import re

_OPENING = re.compile(r'[ \t]*"')


def after_quote(text: str, at: int) -> int:
    """Place after the quote that closes a cell whose quoted part goes on at ``at``; -1 if none does."""
    while True:
        at = text.find('"', at)
        if at < 0:
            return -1
        if text[at + 1 : at + 2] != '"':
            return at + 1
        at += 2


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside or outside a quoted cell ends inside one."""
    at = 0
    if inside:
        at = after_quote(line, 0)
        if at < 0:
            return True
        at = line.find(",", at) + 1
        if not at:
            return False
    while line.find('"', at) >= 0:
        opening = _OPENING.match(line, at)
        if opening:
            at = after_quote(line, opening.end())
            if at < 0:
                return True
        at = line.find(",", at) + 1
        if not at:
            return False
    return False


def cells(record: str) -> list[str]:
    """The cells of a whole record, which may hold line breaks in quoted cells."""
    if '"' not in record:
        return [cell.strip() for cell in record.split(",")]
    found, at = [], 0
    while True:
        opening = _OPENING.match(record, at)
        end = after_quote(record, opening.end()) if opening else -1
        stop = record.find(",", max(end, at))
        stop = len(record) if stop < 0 else stop
        if end >= 0:
            found.append(record[opening.end() : end - 1].replace('""', '"') + record[end:stop].rstrip())
        else:
            found.append(record[at:stop].strip())
        if stop == len(record):
            return found
        at = stop + 1
