"""Cleaning of raw text, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The replacements of each cleaning profile, applied one after the other, so that
# what an earlier step brings together a later step can still remove.
PROFILES: dict[str, tuple[tuple[str, str], ...]] = {
    "filter": (("@", ""), ("?", ""), ("!", ""), ("//", ""), ("\\", ""), ("&", ""), (" ", "")),
    "filter_cjk": (
        ("@", ""), ("?", ""), ("!", ""), ("//", ""), ("\\", ""), ("&", ""), (" ", ""),
        ("？", ""), ("】", ""), ("”", "'"), ("“", "'"),
    ),
    "train": (
        ("@", ""), ("?", ""), ("!", ""), ("//", ""), ("\\", ""), ("&", ""), ("%", ""),
        ("？", ""), ("】", ""), ("”", "'"), ("“", "'"),
    ),
    "stream": (
        ("@", ""), ("?", ""), ("!", ""), ("//", ""), ("\\", ""), ("&", ""),
        ("？", ""), ("】", ""), ("”", "'"), ("“", "'"),
    ),
    "ascii": (("@", ""), ("?", ""), ("!", ""), ("//", ""), ("\\", ""), ("&", "")),
}

# Fixed value: what a trim removes at both ends, U+0000 to U+0020.
CONTROL_CHARS = "".join(chr(c) for c in range(0x21))

BOM = "\ufeff"


def trim_controls(text: Column) -> Column:
    """Drop blanks and control characters at both ends (``trim`` alone drops blanks only)."""
    return F.btrim(text, F.lit(CONTROL_CHARS))


def clean_text(text: Column, profile: str | None) -> Column:
    """Apply a cleaning profile; ``None`` returns the text as it is."""
    if profile is None:
        return text
    steps = PROFILES[profile]
    return trim_controls(reduce(lambda c, step: F.replace(c, F.lit(step[0]), F.lit(step[1])), steps, text))


def removes_blanks(profile: str | None) -> bool:
    """Whether a cleaning profile joins the words of a text."""
    return profile is not None and (" ", "") in PROFILES[profile]


def normalise_word(word: Column, profile: str | None = "train") -> Column:
    """The form in which a lexicon entry can meet a token: cleaned and in lower case."""
    return F.lower(clean_text(word, profile))


def text_lines(text: Column) -> Column:
    """The lines of a text, as an array."""
    return F.split(text, "\r\n|\r|\n")
