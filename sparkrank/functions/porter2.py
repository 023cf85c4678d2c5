"""English (Porter2) stemming of one word, after the published description."""

from __future__ import annotations

VOWELS = frozenset("aeiouy")

# Fixed values of the published algorithm.
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = frozenset("cdeghkmnrt")
WHOLE_WORDS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_PLURAL = frozenset(
    "inning outing canning herring earring proceed exceed succeed".split()
)
REGION_PREFIXES = ("gener", "commun", "arsen")
# suffix -> replacement, applied inside region 1
STEP2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
# suffixes removed inside region 2
STEP4 = (
    "al ance ence er ic able ible ant ement ment ent ism ate iti ous ive ize ion"
).split()


def _region(word: str, start: int) -> int:
    """Index after the first non-vowel that follows a vowel, from ``start``."""
    for i in range(start + 1, len(word)):
        if word[i] not in VOWELS and word[i - 1] in VOWELS:
            return i + 1
    return len(word)


def _has_vowel(part: str) -> bool:
    return any(c in VOWELS for c in part)


def _ends_short(word: str) -> bool:
    if len(word) == 2:
        return word[0] in VOWELS and word[1] not in VOWELS
    return (
        len(word) > 2
        and word[-1] not in VOWELS
        and word[-1] not in "wxY"
        and word[-2] in VOWELS
        and word[-3] not in VOWELS
    )


def _longest(word: str, suffixes) -> str:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else ""


def _plural(word: str) -> str:
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith(("us", "ss")):
        return word
    if word.endswith("s") and _has_vowel(word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    if not suffix:
        return word
    base = word[: -len(suffix)]
    if suffix.startswith("eed"):
        return base + "ee" if len(base) >= r1 else word
    if not _has_vowel(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    if _ends_short(base) and r1 >= len(base):
        return base + "e"
    return base


def _derivational(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, STEP2)
    base = word[: len(word) - len(suffix)]
    if suffix and len(base) >= r1:
        blocked = (suffix == "ogi" and not base.endswith("l")) or (
            suffix == "li" and base[-1:] not in LI_ENDINGS
        )
        if not blocked:
            word = base + STEP2[suffix]

    suffix = _longest(word, STEP3)
    base = word[: len(word) - len(suffix)]
    if suffix and len(base) >= (r2 if suffix == "ative" else r1):
        word = base + STEP3[suffix]

    suffix = _longest(word, STEP4)
    base = word[: len(word) - len(suffix)]
    if suffix and len(base) >= r2 and (suffix != "ion" or base.endswith(("s", "t"))):
        word = base
    return word


def stem_word(word: str) -> str:
    """Stem of a lower-case word; words of one or two letters stay as they are."""
    word = word.replace("’", "'")
    if len(word) <= 2:
        return word
    if word in WHOLE_WORDS:
        return WHOLE_WORDS[word]
    word = word.removeprefix("'")
    # a y that acts as a consonant is written Y until the end
    chars = list(word)
    for i, c in enumerate(chars):
        if c == "y" and (i == 0 or chars[i - 1] in VOWELS):
            chars[i] = "Y"
    word = "".join(chars)

    prefix = next((p for p in REGION_PREFIXES if word.startswith(p)), "")
    r1 = len(prefix) if prefix else _region(word, 0)
    r2 = _region(word, r1)

    possessive = _longest(word, ("'", "'s", "'s'"))
    word = _plural(word[: len(word) - len(possessive)])
    if word in AFTER_PLURAL:
        return word
    word = _past(word, r1)
    if len(word) > 2 and word[-1] in "yY" and word[-2] not in VOWELS:
        word = word[:-1] + "i"
    word = _derivational(word, r1, r2)
    if word.endswith("e"):
        at = len(word) - 1
        if at >= r2 or (at >= r1 and not _ends_short(word[:-1])):
            word = word[:-1]
    elif word.endswith("ll") and len(word) - 1 >= r2:
        word = word[:-1]
    return word.replace("Y", "y")
