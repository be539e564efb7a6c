"""Limits and letters of the language that is being curated."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    """What a segment must be like. The defaults are fixed values for Tatar social-network posts."""

    min_words: int = 6
    max_words: int = 50
    min_chars: int = 30
    max_chars: int = 500
    min_letters: int = 10
    min_marker_letters: int = 6
    one_script_only: bool = False
    #: Letters of the script, and the script a strict profile forbids, as regular expression classes.
    script: str = r"\p{IsCyrillic}"
    foreign_script: str = r"\p{IsLatin}"
    marker_letters: str = "ӘәҮүҖҗҢңӨөҺһ"
    system_messages: tuple[str, ...] = ("Post is not in text format.", "Comment is not in text format.")
    near_distance: int = 2
    short_distance: int = 1
    short_tokens: int = 8

    def __post_init__(self) -> None:
        if self.min_words > self.max_words or self.min_chars > self.max_chars:
            raise ValueError("a minimum lies above its maximum")


DEFAULT = Profile()
