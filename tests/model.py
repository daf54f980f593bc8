"""Plain-Python model of the text rules, written from their description."""

import re
import unicodedata

from paperward.functions import lexicon as L
from paperward.functions.unicode import CONFUSABLES

SPACES = set("\t\n\x0b\x0c\r \xa0     　﻿") | {
    chr(c) for c in range(0x2000, 0x200B)
}


def within(code, *ranges):
    return any(lo <= code <= hi for lo, hi in ranges)


def invisible(ch):
    return within(
        ord(ch), (0xAD, 0xAD), (0x180E, 0x180E), (0x200B, 0x200F), (0x202A, 0x202E),
        (0x2060, 0x2064), (0x206A, 0x206F), (0xFEFF, 0xFEFF), (0xE0000, 0xE007F),
    )


def bidi(ch):
    return within(ord(ch), (0x200E, 0x200F), (0x202A, 0x202E), (0x2066, 0x2069))


def zero_width(ch):
    return within(
        ord(ch), (0xAD, 0xAD), (0x180E, 0x180E), (0x200B, 0x200D), (0x2060, 0x2064),
        (0xFEFF, 0xFEFF), (0xE0000, 0xE007F),
    )


def squeeze(text):
    out = []
    for ch in text:
        if ch in SPACES:
            if out and out[-1] != " ":
                out.append(" ")
        else:
            out.append(ch)
    return "".join(out).strip(" ")


def normalize(raw):
    composed = unicodedata.normalize("NFKC", raw)
    flags = set()
    if composed != raw:
        flags.add("compatibility-form")
    if any(map(bidi, composed)):
        flags.add("bidi-control")
    if any(map(zero_width, composed)):
        flags.add("zero-width")
    shown = [c for c in composed if not invisible(c)]
    if any(c in CONFUSABLES for c in shown):
        flags.add("confusable")
    folded = "".join(CONFUSABLES.get(c, c) for c in shown)
    bare = "".join(
        c for c in unicodedata.normalize("NFD", folded) if not 0x300 <= ord(c) <= 0x36F
    )
    return squeeze(bare.lower()), sorted(flags)


def imperative(norm):
    words = set(re.findall(r"[a-z0-9_]+", re.sub(r"[^\x00-\x7f]", " ", norm)))
    if not words & set(L.SECOND_PERSON):
        return False
    for clause in re.split(r"[.!?;:\n|]+", norm):
        rest = clause.lstrip(" \"'([")
        word = re.match(r"[a-z]*", rest).group()
        if word in L.IMPERATIVE_VERBS:
            return True
    return False


def classify(raw):
    norm, flags = normalize(raw)
    found = {cat for cat, _, phrase in L.phrases() if phrase in norm}
    if imperative(norm):
        found.add("imperative-address")
    names = sorted(found)
    if len(names) >= 2:
        return names, "confident", flags
    if names and names[0] in ("delimiter-mimicry", "role-address"):
        return names, "tentative", flags
    return None


def payload(raw, limit=200):
    kept = "".join(
        " " if ord(c) <= 0x1F or 0x7F <= ord(c) <= 0x9F else c
        for c in raw
        if not invisible(c)
    )
    out, used = [], 0
    for ch in squeeze(kept):
        used += 2 if ord(ch) > 0xFFFF else 1
        if used > limit:
            break
        out.append(ch)
    return "".join(out)


def length(raw):
    return sum(2 if ord(c) > 0xFFFF else 1 for c in raw)
