"""Person names typed by people: parts, phonetic codes, Jaro-Winkler, nicknames."""

from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from rolodar.llm.plaintext import plain

# Given names and their usual short forms.
NICKNAMES = """
abigail abby gail; aleksander olek alex; alexander alex sasha; andrew andy drew; anthony tony; barbara barb babs barbie;
benjamin ben benji benny; catherine cathy kate katie; charles charlie chuck chas; christopher chris; concepcion concha;
daniel dan danny; david dave; deborah deb debbie; dolores lola; dorothy dot dottie dolly; edward ed eddie ted ned;
eleanor ellie nell nellie; elizabeth liz betty beth lizzie eliza libby; francisco paco pancho; frederick fred freddie;
gabriel gabe; giuseppe beppe peppe; gregory greg; guillermo memo; harold hal harry; henry hank harry; ignacio nacho;
isabella bella izzy; jacqueline jackie; james jim jimmy jamie; jennifer jen jenny; john jack johnny; jose pepe;
joseph joe joey; josephine josie posy jo; katarzyna kasia; katherine kathy kate katie; konstantin kostya;
lawrence larry laurie; leonard len lenny leo; malgorzata gosia; margaret maggie peggy meg marge; matthew matt;
michael mike mick; mildred millie; mohammed mo; nathaniel nat nate; nicholas nick; patricia pat patty trish; pamela pam;
penelope penny; philip phil pip; priyanka priya; rajesh raj; rebecca becca becky; richard dick rick rich ricky;
robert bob bobby rob robbie; ronald ron ronnie; samuel sam sammy; stephanie steph; stephen steve; susan sue suzie susie;
theodore theo ted teddy; thomas tom tommy; timothy tim timmy; victoria vicky tori vic; vincent vince vinnie;
walter walt wally; william bill billy will willie; winifred winnie; yevgenia zhenya; zachary zach zak zack
"""
ROOTS: dict[str, frozenset[str]] = {}
for _group in NICKNAMES.split(";"):
    _root, *_short = _group.split()
    for _name in (_root, *_short):
        ROOTS[_name] = ROOTS.get(_name, frozenset()) | {_root}

_TITLES = frozenset("mr mrs ms miss mx dr prof rev sir madam mme mlle m herr frau sr sra don dona ing dipl hon capt".split())
_CREDENTIALS = frozenset("cpa phd md mba jd esq pe rn dds dvm cfa cpsp pmp msc bsc ma ba ms llm".split())
_SUFFIX = {"jr": "jr", "junior": "jr", "sr": "sr", "senior": "sr", "ii": "ii", "iii": "iii", "iv": "iv", "2nd": "ii", "3rd": "iii", "4th": "iv"}
_NICK = re.compile(r"[\"“”«»(\[]\s*([^\"“”«»()\[\]]+?)\s*[\"“”«»)\]]|(?<!\w)['‘’]\s*([^'‘’]+?)\s*['‘’](?!\w)")
_WORDS = re.compile(r"[^\W_]+(?:['’‑-][^\W_]+)*")


class Person(NamedTuple):
    """A typed name in parts; ``firsts`` are further spellings of the given name, in no order."""

    words: list[str]
    firsts: list[str]
    initials: list[str]
    suffix: str


def parse(full: str | None, first: str | None = None, nickname: str | None = None) -> Person:
    """Plain parts of a typed name: titles and credentials go, a generational suffix is kept apart."""
    raw = full or ""
    nicks = [a or b for a, b in _NICK.findall(raw)]
    body = plain(_NICK.sub(" ", raw))
    reversed_ = re.match(r"\s*([^,;]+?)\s*[,;]\s*([^,;]+?)\s*(?:[,;](.*))?$", body)
    if reversed_ and reversed_.group(2).strip(" .") not in _SUFFIX and reversed_.group(2).strip(" .") not in _CREDENTIALS:
        given = reversed_.group(2).split()
        # "Family, Given Jr": what follows the given name belongs behind the whole name.
        after = [given.pop()] if len(given) > 1 and given[-1].strip(".") in _SUFFIX.keys() | _CREDENTIALS else []
        body = " ".join([*given, reversed_.group(1), *after, reversed_.group(3) or ""])
    words: list[str] = []
    initials: list[str] = []
    suffix = ""
    found = [w.replace("'", "").replace("’", "").replace("-", "").replace("‑", "") for w in _WORDS.findall(body)]
    for i, w in enumerate(found):
        if w in _SUFFIX and (i > 1 or i == len(found) - 1) and len(found) > 1:
            suffix = suffix or _SUFFIX[w]
        elif w in _TITLES and i == 0 and len(found) > 2 - (w != "m"):
            continue
        elif w in _CREDENTIALS and i >= 2:
            continue
        elif len(w) == 1:
            initials.append(w)
        else:
            words.append(w)
    firsts: list[str] = []
    for text in (first, nickname, *nicks):
        for w in _WORDS.findall(plain(text or "")):
            w = w.replace("'", "").replace("’", "").replace("-", "")
            if len(w) == 1:
                initials.append(w)
            elif w not in firsts:
                firsts.append(w)
    # A name typed without its blank: cut the given name off either end.
    if len(words) == 1:
        for f in firsts:
            w = words[0]
            if len(w) >= len(f) + 3 and (w.startswith(f) or w.endswith(f)):
                words = [f, w[len(f) :]] if w.startswith(f) else [w[: -len(f)], f]
                break
    return Person(words, firsts, sorted(set(initials)), suffix)


_SOUND = str.maketrans("bfpvcgjkqsxzdtlmnr", "111122222222334556")


def phonetic(word: str) -> str:
    """Consonant code of a word with its first letter (vowels, doubled and silent letters do not matter)."""
    if not word:
        return ""
    rest = re.sub(r"[aeiouyhw]", "", word[1:].replace("ph", "f").replace("ck", "k")).translate(_SOUND)
    head = word[0]
    code = head
    last = ""
    for c in rest:
        if c != last:
            code += c
        last = c
    return code[:5]


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    window = max(la, lb) // 2 - 1
    used = [False] * lb
    hits: list[str] = []
    for i, c in enumerate(a):
        for j in range(max(0, i - window), min(lb, i + window + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    others = [b[j] for j in range(lb) if used[j]]
    t = sum(x != y for x, y in zip(hits, others, strict=True)) / 2
    jaro = (m / la + m / lb + (m - t) / m) / 3
    prefix = 0
    while prefix < min(4, la, lb) and a[prefix] == b[prefix]:
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


def one_slip(a: str, b: str) -> bool:
    """At most one letter inserted, dropped, changed, or two neighbours swapped."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1:
        return False
    i = 0
    while i < min(la, lb) and a[i] == b[i]:
        i += 1
    if la == lb:
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if la > lb else a[i:] == b[i + 1 :]


def roots(word: str) -> frozenset[str]:
    return ROOTS.get(word, frozenset((word,)))


def _drops(word: str) -> set[str]:
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


_NEAR: dict[str, set[str]] = {}
for _name in ROOTS:
    if len(_name) >= 4:
        for _d in _drops(_name):
            _NEAR.setdefault(_d, set()).add(_name)


@lru_cache(maxsize=50_000)
def near_names(word: str) -> frozenset[str]:
    """Known names that a given name may be a slip of; none if it is known itself."""
    if word in ROOTS or len(word) < 4:
        return frozenset()
    return frozenset(n for d in _drops(word) for n in _NEAR.get(d, ()) if one_slip(word, n))


@lru_cache(maxsize=50_000)
def slip_roots(word: str) -> frozenset[str]:
    """Roots of a given name, also of one typed with a slip; the word itself if it is near no known name."""
    near = near_names(word)
    return frozenset().union(*(ROOTS[n] for n in near)) if near else roots(word)


def nickname_equal(a: str, b: str) -> bool:
    return bool(roots(a) & roots(b))
