"""Porter's suffix stripping (M. F. Porter, 1980) with the usual later changes, one word at a time.

Called once per distinct word of a corpus, never per token.
"""

from __future__ import annotations

import re

# fixed values: words stemmed by table
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing",
    "canning": "canning", "cannings": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}

# fixed values: suffix -> replacement where the stem has at least one vowel-consonant run
STEP_2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"),
          ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
          ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"),
          ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("fulli", "ful")]
STEP_3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]

# fixed values: suffixes dropped where the stem has at least two vowel-consonant runs
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
          "ate", "iti", "ous", "ive", "ize"]


def _shape(stem: str) -> str:
    """The stem as a string of ``v`` and ``c``; ``y`` is a vowel after a consonant."""
    marks = ""
    for i, ch in enumerate(stem):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and marks[-1] == "c")
        marks += "v" if vowel else "c"
    return marks


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _short_end(stem: str) -> bool:
    shape = _shape(stem)
    return shape == "vc" or (shape.endswith("cvc") and stem[-1] not in "wxy")


def _swap_longest(word: str, rules: list[tuple[str, str]]) -> str:
    hits = [(old, new) for old, new in rules if word.endswith(old)]
    if not hits:
        return word
    old, new = max(hits, key=lambda r: len(r[0]))
    stem = word[: len(word) - len(old)]
    return stem + new if _measure(stem) > 0 else word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _past(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for ending in ("ed", "ing"):
        stem = word[: -len(ending)]
        if word.endswith(ending) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if len(stem) > 1 and stem[-1] == stem[-2] and _shape(stem)[-1] == "c":
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _short_end(stem) else stem
    return word


def _final_y(word: str) -> str:
    stem = word[:-1]
    return stem + "i" if word.endswith("y") and len(stem) > 1 and _shape(stem)[-1] == "c" else word


def _second(word: str) -> str:
    if word.endswith("alli") and _measure(word[:-4]) > 0:
        return _second(word[:-2])
    if word.endswith("logi"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    return _swap_longest(word, STEP_2)


def _fourth(word: str) -> str:
    hits = [s for s in STEP_4 if word.endswith(s)]
    if not hits:
        return word
    ending = max(hits, key=len)
    stem = word[: -len(ending)]
    ok = _measure(stem) > 1 and (ending != "ion" or stem.endswith(("s", "t")))
    return stem if ok else word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        m = _measure(word[:-1])
        if m > 1 or (m == 1 and not _short_end(word[:-1])):
            word = word[:-1]
    return word[:-1] if word.endswith("ll") and _measure(word[:-1]) > 1 else word


def stem(word: str) -> str:
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    for step in (_plural, _past, _final_y, _second):
        word = step(word)
    return _tidy(_fourth(_swap_longest(word, STEP_3)))
