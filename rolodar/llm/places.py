"""Postal addresses in comparable parts."""

from __future__ import annotations

import re
from typing import NamedTuple

from rolodar.llm.plaintext import plain

# Common short forms of street types, directions, and of the states' names.
TYPES = {
    "street": "st str strt", "avenue": "ave av aven avn", "road": "rd", "drive": "dr drv", "lane": "ln", "court": "ct crt",
    "place": "pl plc", "square": "sq sqr", "terrace": "ter terr trce", "boulevard": "blvd boul bvd blv", "parkway": "pkwy pky pkway",
    "highway": "hwy hiway hwy", "circle": "cir circ", "trail": "trl", "way": "wy", "alley": "aly", "crescent": "cres cresc",
    "close": "cl", "expressway": "expy", "plaza": "plz", "route": "rte",
}
TYPE_OF = {s: full for full, short in TYPES.items() for s in (full, *short.split())}
DIRECTIONS = {
    "n": "n", "north": "n", "s": "s", "south": "s", "e": "e", "east": "e", "w": "w", "west": "w",
    "ne": "ne", "northeast": "ne", "nw": "nw", "northwest": "nw", "se": "se", "southeast": "se", "sw": "sw", "southwest": "sw",
}
STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca", "colorado": "co", "connecticut": "ct",
    "delaware": "de", "district of columbia": "dc", "florida": "fl", "georgia": "ga", "hawaii": "hi", "idaho": "id", "illinois": "il",
    "indiana": "in", "iowa": "ia", "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md",
    "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo", "montana": "mt",
    "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj", "new mexico": "nm", "new york": "ny",
    "north carolina": "nc", "north dakota": "nd", "ohio": "oh", "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa",
    "rhode island": "ri", "south carolina": "sc", "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt",
    "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
}
_CODES = set(STATES.values())
_CITY_WORDS = {"mt": "mount", "st": "saint", "ft": "fort", "ste": "sainte", "n": "north", "s": "south", "e": "east", "w": "west"}
_ZIP_END = re.compile(r"[\s,]*\b(\d{5})(?:\s*-\s*\d{4})?\s*$")
_UNIT = re.compile(r"(?:\b(?:apartment|apt|unit|suite|ste|flat|room|rm|number|no|nr)\b\.?\s*#?\s*|#\s*)(\d+\s?[a-z]?|[a-z]\d*)\b(?!\s*box)")
_BOX = re.compile(r"\b(?:p\.?\s*o\.?\s*b(?:ox)?|post\s*office\s*box|box)\.?\s*#?\s*(\d+)\b")
_STATE_END = re.compile(
    r"(?:^|[\s,])(" + "|".join(sorted((re.escape(s).replace(r"\ ", r"\s+") for s in STATES), key=len, reverse=True)) + r"|[a-z]\.?\s?[a-z])\.?\s*$"
)
_COUNTRY_END = re.compile(r"[\s,]+(?:u\.?s\.?a?\.?|united states(?: of america)?)\s*$")


class Place(NamedTuple):
    """One address in parts; '' where a part is missing. ``line`` is the street's name without blanks, ``words`` with."""

    number: str
    direction: str
    line: str
    kind: str
    unit: str
    box: str
    city: str
    state: str
    zip: str
    words: str = ""


def state_code(text: str) -> str:
    t = re.sub(r"\s+", " ", plain(text)).strip(" .,")
    if t in STATES:
        return STATES[t]
    t = re.sub(r"[^a-z]", "", t)
    return t if t in _CODES else ""


def city_key(text: str) -> str:
    ws = re.findall(r"[a-z0-9]+", plain(text))
    if len(ws) > 1:
        ws[0] = _CITY_WORDS.get(ws[0], ws[0])
    return " ".join(ws)


def parse(street: str | None, city: str | None, state: str | None, postal: str | None, po_box: str | None, extended: str | None) -> Place:
    """Parts of an address, wherever they stand."""
    s = re.sub(r"[ \t]+", " ", plain(street or "").replace("\r", "\n")).strip()
    c, st = (city or "").strip(), (state or "").strip()
    z = re.sub(r"\D", "", postal or "")[:5]
    code = state_code(st)
    box = unit = ""
    # A tail "City ST ZIP" in the street, or in the city.
    tail_city = ""
    for where in ("s", "c"):
        text = s if where == "s" else plain(c)
        if not text:
            continue
        t = _COUNTRY_END.sub("", text)
        m = _ZIP_END.search(t)
        has_zip = bool(m) and m.start() > 0
        cut = t[: m.start()] if has_zip else t
        ms = _STATE_END.search(cut)
        found = state_code(ms.group(1)) if ms else ""
        multi = "," in cut or "\n" in cut
        if where == "s" and found and (has_zip or (multi and not c)):
            body = cut[: ms.start()].rstrip(" ,\n")
            parts = [p.strip(" .") for p in re.split(r"[,\n]+", body) if p.strip(" .")]
            if len(parts) > 1 and not any(ch.isdigit() for ch in parts[-1]):
                tail_city = parts[-1]
                s = " , ".join(parts[:-1])
                code = code or found
                z = z or (m.group(1) if has_zip else "")
        elif where == "s" and has_zip and multi and not c:
            parts = [p.strip(" .") for p in re.split(r"[,\n]+", cut) if p.strip(" .")]
            if len(parts) > 1 and not any(ch.isdigit() for ch in parts[-1]):
                tail_city, s, z = parts[-1], " , ".join(parts[:-1]), z or m.group(1)
        elif where == "c" and (has_zip or (found and multi)):
            if found:
                cut = cut[: ms.start()]
                code = code or found
            z = z or (m.group(1) if has_zip else "")
            c = cut.strip(" ,")
    c = c or tail_city
    for text in (po_box, extended, s, c):
        t = plain(text or "")
        m = _BOX.search(t)
        if m and not box:
            box = m.group(1).lstrip("0") or "0"
    if not box and po_box and re.fullmatch(r"\s*#?\s*\d+\s*", po_box):
        box = re.sub(r"\D", "", po_box).lstrip("0")
    s = _BOX.sub(" ", s)
    if _BOX.search(plain(c)):
        c = _BOX.sub(" ", plain(c)).strip(" ,")
    for text in (extended, s, po_box):
        t = plain(text or "")
        m = _UNIT.search(t)
        if m and not unit:
            unit = re.sub(r"\s", "", m.group(1)).lstrip("0")
            if text is s:
                s = s[: m.start()] + " " + s[m.end() :]
    if not unit and extended and re.fullmatch(r"\s*\d+\s?[a-z]?\s*", plain(extended)):
        unit = re.sub(r"\s", "", plain(extended))
    ext = _UNIT.sub(" ", plain(extended or ""))
    words = re.findall(r"\d+[a-z]?(?:[-/]\d+[a-z]?)?|[a-z']+", s)
    if not words and re.search(r"[a-z]{3}", ext) and re.search(r"\d", ext):
        words = re.findall(r"\d+[a-z]?(?:[-/]\d+[a-z]?)?|[a-z']+", ext)
    number = ""
    if words and words[0][0].isdigit():
        number, words = words[0], words[1:]
    elif words and words[-1][0].isdigit():
        number, words = words[-1], words[:-1]
    direction = kind = ""
    if len(words) > 1 and words[0] in DIRECTIONS:
        direction, words = DIRECTIONS[words[0]], words[1:]
    elif len(words) > 1 and words[-1] in DIRECTIONS and (len(words) > 2 or words[0] not in TYPE_OF):
        direction, words = DIRECTIONS[words[-1]], words[:-1]
    if len(words) > 1 and words[-1] in TYPE_OF:
        kind, words = TYPE_OF[words[-1]], words[:-1]
    words = [w.replace("'", "") for w in words]
    return Place(number.lstrip("0"), direction, "".join(words), kind, unit, box, city_key(c), code, z, " ".join(words))


def distance(a: str, b: str, most: int) -> int:
    """Letters inserted, dropped, changed or swapped with their neighbour between two words; ``most`` + 1 if more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def assignment(a: list[str], b: list[str], most: int) -> int:
    """Least total distance of two streets' words, each assigned to one of the other's whatever their order; words
    without a partner cost all their letters. Exact, by dynamic programming over the sets of assigned words."""
    if len(a) > len(b):
        a, b = b, a
    best = {0: 0}
    for x in a:
        after: dict[int, int] = {}
        for used, cost in best.items():
            for j, y in enumerate(b):
                if not used >> j & 1:
                    c = cost + distance(x, y, most)
                    if c <= most and c < after.get(used | 1 << j, most + 1):
                        after[used | 1 << j] = c
        best = after
    free = {used: cost + sum(len(y) for j, y in enumerate(b) if not used >> j & 1) for used, cost in best.items()}
    return min([*free.values(), distance("".join(a), "".join(b), most), most + 1])
