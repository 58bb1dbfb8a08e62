"""Unit values: a light clean-up of what was delivered."""

from __future__ import annotations

import re

from waymark.functions.casing import proper_word

# Words that name a kind of unit.
DESIGNATORS = frozenset("APARTMENT APT UNIT SUITE STE LOT SPACE SPC BLDG BUILDING SITE TRLR TRAILER CONDO ROOM RM SLIP CABIN FLOOR FL CAMPSITE PENTHOUSE PH OFFICE OFC DEPT HANGAR PIER STOP".split())


def _kind(token: str) -> str | None:
    return word if (word := token.rstrip(".").upper()) in DESIGNATORS else None


def _token(token: str) -> str:
    if kind := _kind(token):
        return kind.capitalize()
    return proper_word(token.upper()) if len(token) > 2 and token.isalpha() else token.upper()


def unit_value(unit: str | None, building: str | None = None) -> tuple[str | None, list[str]]:
    """The unit, or else the building, and flags; inputs are cleaned."""
    flags = ["building_not_in_unit"] if unit and building and unit.casefold() != building.casefold() else []
    tokens = re.sub(r"#\s+", "#", unit or building or "").split()
    if not tokens:
        return None, flags
    if all(token == "#" or _kind(token) for token in tokens):
        return None, [*flags, "unit_designator_only"]
    return " ".join(map(_token, tokens)), flags
