"""Proper case for names that arrive in one case; names in mixed case are taken as they are."""

from __future__ import annotations

import re
from collections.abc import Collection

# Words kept small inside a name, Roman numerals, abbreviations without a vowel that are words.
SMALL_WORDS = frozenset("del de di du la las los el of on for an the at to in via by or and but".split())
ENGLISH_SMALL_WORDS = frozenset("of on the at in and".split())
ROMAN = frozenset("II III IV VI VII VIII IX XI XII XIII".split())
SPOKEN = frozenset("JR SR ST MT FT DR MR MRS MS".split())

ORDINAL = re.compile(r"0*(\d+)(st|nd|rd|th)", re.I)
PART = re.compile(r"(?P<after>')?(?P<word>[^-'/&.]+)")


def _word(word: str) -> str:
    big = word.upper()
    if found := ORDINAL.fullmatch(word):
        return found[1] + found[2].lower()
    if len(big) == 1 or big in ROMAN or any(map(str.isdigit, big)):
        return big
    if big[:2] == "MC" and len(big) > 3 and big.isalpha():
        return f"Mc{big[2:].capitalize()}"
    spoken = big in SPOKEN or any(letter in "AEIOUY" for letter in big)
    return big.capitalize() if spoken else big


def _part(found: re.Match) -> str:
    mark, word = found["after"] or "", found["word"]
    return mark + (word.lower() if mark and word.upper() in ("S", "T") else _word(word))


def proper_word(token: str, first: bool = True, capitals: Collection[str] = (), small: Collection[str] = SMALL_WORDS) -> str:
    """One word of a name; `capitals` stay in capitals, `small` words are small unless first."""
    if not first and token.lower() in small:
        return token.lower()
    if ORDINAL.fullmatch(token) or token.upper() == "MLK":
        return _word(token)
    if not (token.isupper() or token.islower()):  # mixed: only what plain title case spoils is mended
        if token.endswith("'S"):
            return token[:-2] + "'s"
        return f"Mc{token[2:].capitalize()}" if re.fullmatch("Mc[a-z]{2,}", token) else token
    return token.upper() if token.upper() in capitals else PART.sub(_part, token)


def proper_name(text: str, capitals: Collection[str] = (), small: Collection[str] = SMALL_WORDS) -> str:
    return " ".join(proper_word(token, not place, capitals, small) for place, token in enumerate(text.split()))
