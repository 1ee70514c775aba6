"""ASCII names for columns whose names hold other characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping

from pyspark.sql import DataFrame

# Latin spelling of the Hangul letters, in code-point order.
INITIALS = "g kk n d tt r m b pp s ss - j jj c k t p h".replace("-", "").split(" ")
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u weo we wi yu eu yi i".split(" ")
FINALS = "- g gg gs n nj nh d l lg lm lb ls lt lp lh m b bs s ss ng j c k t p h".replace("-", "").split(" ")

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


def _ascii_char(ch: str) -> str:
    if ord(ch) < 128:
        return ch
    if HANGUL_FIRST <= ord(ch) <= HANGUL_LAST:
        syllable, final = divmod(ord(ch) - HANGUL_FIRST, len(FINALS))
        initial, vowel = divmod(syllable, len(VOWELS))
        return INITIALS[initial] + VOWELS[vowel] + FINALS[final]
    plain = "".join(c for c in unicodedata.normalize("NFKD", ch) if ord(c) < 128)
    return plain or f"u{ord(ch):04x}"


def ascii_name(name: str) -> str:
    return "".join(_ascii_char(c) for c in unicodedata.normalize("NFC", name))


def ascii_map(names: list[str], overrides: Mapping[str, str] | None = None) -> dict[str, str]:
    """New name per column; a collision raises instead of yielding two columns of one name."""
    overrides = overrides or {}
    renamed = {n: overrides.get(n, ascii_name(n)) for n in names}
    seen: dict[str, str] = {}
    for old, new in renamed.items():
        if new in seen:
            raise ValueError(f"Columns {seen[new]!r} and {old!r} would both be named {new!r}.")
        seen[new] = old
    return renamed


def with_ascii_names(df: DataFrame, overrides: Mapping[str, str] | None = None) -> DataFrame:
    renamed = ascii_map(df.columns, overrides)
    return df.toDF(*[renamed[n] for n in df.columns])
