"""Splitting texts for byte-level BPE without matching the pattern over every character.

The usual BPE pattern lets one optional space open a word, so a space between two non-space characters always starts
a new match, whatever stands around it.  A text without other white-space runs at its spaces is cut there with
``str.split`` and each distinct chunk is looked up once; the few other texts are matched as a whole.
"""

from __future__ import annotations

import re

_UNSAFE = re.compile(r"\s | \s")


def splits(text: str) -> bool:
    """Whether no space of ``text`` touches other white space or an end of the text."""
    return not (text[:1] == " " or text[-1:] == " " or _UNSAFE.search(text))


def chunks(text: str) -> list[str] | None:
    """``text`` cut before every space, or None where a space touches other white space or an end of the text."""
    if not splits(text):
        return None
    head, *rest = text.split(" ")
    return [head, *(" " + x for x in rest)]
