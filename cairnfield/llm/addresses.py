"""Postal addresses typed by people: their parts, and the city that each means.

`parse` finds the part of a record that states an address, wherever it was typed, and gives its house number, direction,
street name, suffix or post-office box. What people add to an address is not listed here but learnt: a `Lexicon` holds the
words that follow a suffix rather than precede it, and the texts that fill other fields. `CityIndex` finds the listed city
that a typed city, state and zip mean.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

from cairnfield.functions import postal

#: Street suffixes by spelling, from the public postal list, with a few ways to write them that it lacks.
SUFFIX_OF = {k: v.lower() for k, v in postal.suffixes().items()} | {"la": "lane", "crt": "court", "lp": "loop", "tr": "trail", "plc": "place", "bvd": "boulevard", "blv": "boulevard", "crsg": "crossing"}
#: Those that name a kind of road, and so end the name of a street; the others may be words of it.
ROADS = frozenset(r.lower() for r in postal.ROADS)
#: Directions and the ways to shorten them.
DIRECTIONS = {
    "north": "n no nth", "south": "s so sth", "east": "e ea", "west": "w we", "north east": "ne northeast", "north west": "nw northwest", "south east": "se southeast", "south west": "sw southwest",
}
#: Words before the name of a city and the ways to shorten them.
CITY_WORDS = {"north": "n no", "south": "s so", "east": "e", "west": "w", "new": "nw", "port": "pt prt", "fort": "ft", "mount": "mt mnt", "saint": "st snt", "lake": "lk"}
#: Words for a part of a site, which is followed by a number or a letter.
SUBLOCATIONS = "building bldng bldg bld warehouse whse whs plant plnt plt dock dk door gate gt room rm suite ste unit floor flr level lvl cell bay rack zone aisle line sector apartment apt lot"
#: Numbers of streets written out.
ORDINALS = dict(zip("first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split(), "1 2 3 4 5 6 7 8 9 10 11 12".split(), strict=True))


def _inverse(table: dict[str, str]) -> dict[str, str]:
    return {short: full for full, shorts in table.items() for short in (full, *shorts.split())}


DIRECTION_OF, CITY_WORD_OF = _inverse(DIRECTIONS), _inverse(CITY_WORDS)
LONG_ROADS = sorted(s for s in ROADS if len(s) >= 4)
_SUB = re.compile(rf"\b(?:{SUBLOCATIONS.replace(' ', '|')})\s*#?\s*(?:\d{{1,4}}[a-z]?|[a-z])\b|\bdr\s*#\s*\w+|#\s*\w+")
_BOX = re.compile(r"\b(?:p\s?o\s?|post\s?office\s?)?(?:box|bx)\s*#?\s*0*(\d+)\b")
_LETTERS = re.compile(r"\b([a-z])\.(?=[a-z]\b)")
_DIGIT = re.compile(r"\d")
_SPLIT_ORDINAL = re.compile(rf"\b(\d+) (st|nd|rd|th) (?=(?:{'|'.join(k for k, v in SUFFIX_OF.items() if v in ROADS)})\b)")
_NUMBER = re.compile(r"0*(\d+)(.*)")
_ORDINAL = re.compile(r"\d+(?:st|nd|rd|th)$")
_ROUTE = re.compile(r"(county road|highway|state road|route|interstate) \d")


@dataclass(frozen=True)
class Lexicon:
    """What is learnt of the records: words that follow streets' suffixes, and texts that fill other fields."""

    tails: frozenset[str] = field(default_factory=frozenset)
    fillers: frozenset[str] = field(default_factory=frozenset)


NOTHING = Lexicon()


def distance(a: str, b: str, most: int) -> int:
    """Edits between two words, a swap of neighbours being one; `most` + 1 where there are more than `most`."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return min(len(a) + len(b), most + 1)
    before, last = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, now[j - 1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            now.append(cost)
        if min(now) > most:
            return most + 1
        before, last = last, now
    return min(last[-1], most + 1)


@lru_cache(100_000)
def suffix_of(word: str) -> str | None:
    """The suffix that a word means, one slip allowed in a kind of road of four letters or more."""
    if word in SUFFIX_OF:
        return SUFFIX_OF[word]
    if len(word) >= 4:
        # in a suffix of four letters another letter makes another word: land and lade are no lane
        near = [s for s in LONG_ROADS if distance(word, s, 1) <= 1 and (len(s) > 4 or len(word) != 4 or sorted(word) == sorted(s))]
        return near[0] if near else None
    return None


@dataclass(slots=True)
class Address:
    """The parts of one stated address; empty where not stated. `name` is the street's name with its words run together,
    `words` has them apart. A post-office box has the name `po box`."""

    number: str = ""
    direction: str = ""
    name: str = ""
    suffix: str = ""
    words: str = ""

    @property
    def worth(self) -> int:
        """How much of an address it is."""
        if self.name == "po box":
            return 6
        route = bool(_ROUTE.match(self.name))
        ends = self.suffix or self.words.rpartition(" ")[2] in SUFFIX_OF
        return (2 * bool(self.number) + 3 * bool(ends) + 3 * route) if self.name else 0


def _clean(text: str) -> str:
    text = text.lower().replace("&amp;", "&").replace("'", "").replace("’", "")
    text = _LETTERS.sub(r"\1", text)
    text = re.sub(r"(?<=[a-z])-(?=[a-z])", "", text)
    text = re.sub(r"[^a-z0-9#&À-ɏ]+", " ", text)
    return " ".join(text.split())


def _directions(words: list[str]) -> tuple[str, list[str]]:
    """Directions at the start and what follows them."""
    if len(words) > 1 and words[0] in DIRECTION_OF:
        first = DIRECTION_OF[words[0]]
        if len(words) > 2 and first in ("north", "south") and DIRECTION_OF.get(words[1]) in ("east", "west"):
            return f"{first} {DIRECTION_OF[words[1]]}", words[2:]
        return first, words[1:]
    return "", words


def _route(words: list[str]) -> str | None:
    """A numbered road at the start of the words."""
    text = " ".join(words[:4])
    if m := re.match(r"(?:c ?r|(co|cnty|cty|c\w{3,7}) ?(\w+?)) ?0*(\d+)\b", text):
        county = m[1] in (None, "co", "cnty", "cty") or distance(m[1], "county", 1) <= 1
        if county and (m[2] is None or suffix_of(m[2]) == "road"):
            return f"county road {m[3]}"
    if m := re.match(r"(?:us )?(\w+) ?0*(\d+)\b", text):
        if suffix_of(m[1]) == "highway":
            return f"highway {m[2]}"
    if m := re.match(r"(?:i|int|interstate) ?(\d+)\b", text):
        return f"interstate {m[1]}"
    return None


def _suffix_at(words: list[str]) -> tuple[str, int]:
    """The suffix and its place: the first word but the first one that names a kind of road, or the next one where that does
    too, else the last that might with a slip; ('', length) for none. A word for a feature is part of the name."""
    for i in range(1, len(words)):
        if SUFFIX_OF.get(words[i]) in ROADS:
            if i + 1 < len(words) and SUFFIX_OF.get(words[i + 1]) in ROADS:
                i += 1
            return SUFFIX_OF[words[i]], i
    for i in range(len(words) - 1, 0, -1):
        if words[i] not in SUFFIX_OF and (near := suffix_of(words[i])):
            return near, i
    return "", len(words)


def parse_line(text: str | None, number: str | None = None, lexicon: Lexicon = NOTHING) -> Address:
    """The address that one line states; `number` is a house number stated apart from it."""
    line = _clean(text or "")
    found = _NUMBER.match(_clean(number or ""))
    number = found[1] if found else ""
    if line in lexicon.fillers:
        return Address(number)
    if m := _BOX.search(line):
        return Address(m[1], "", "po box", "", "po box")
    words = _SPLIT_ORDINAL.sub(r"\1\2 ", _SUB.sub(" ", line).strip()).replace("#", " ").replace("&", " ").split()
    if " ".join(words) in lexicon.fillers:
        return Address(number)
    if words and (m := re.match(r"0*(\d+)([a-zÀ-ɏ]*)$", words[0])) and not (_ORDINAL.match(words[0]) and (number or len(words) < 3 or suffix_of(words[1]))):
        if not number or number == m[1]:
            number = m[1]
            words = ([m[2]] if m[2] else []) + words[1:]
    elif words and not number and (at := next((i for i, w in enumerate(words) if w.isdigit()), None)) is not None and at + 1 < len(words) and not _route(_directions(words)[1]):
        number, words = words[at].lstrip("0") or "0", words[at + 1 :]
    direction, words = _directions(words)
    if route := _route(words):
        return Address(number, direction, route, "", route)
    suffix, end = _suffix_at(words)
    if not suffix:  # what usually follows a suffix is no part of a name that has none
        while end > 1 and (words[end - 1] in lexicon.tails or (_DIGIT.search(words[end - 1]) and not _ORDINAL.match(words[end - 1]))):
            end -= 1
        end = next((i for i in range(1, end - 1) if words[i] in lexicon.tails and words[i + 1] in lexicon.tails), end)
        words = words[:end]
        if end > 1 and words[-1] in SUFFIX_OF:
            words[-1] = SUFFIX_OF[words[-1]]
    if not direction:
        tail = words[end + 1 : end + 3] if suffix else words[-2:]
        if suffix and tail and tail[0] in DIRECTION_OF:
            direction = _directions([*tail, ""])[0]
        elif not suffix and len(words) > 1 and words[-1] in DIRECTION_OF and len(words[-1]) < 6:
            direction, end = DIRECTION_OF[words[-1]], len(words) - 1
    name = "".join(words[:end])
    if suffix and name.isdigit() and words[end] == {"1": "st", "3": "rd"}.get(name[-1]) and name[-2:-1] != "1":
        after = words[end + 1] if end + 1 < len(words) else ""
        suffix = (suffix_of(after) or suffix) if after else ""  # 93 rd is the end of an ordinal rather than a road
    if _ORDINAL.match(name):
        name = name[:-2]
    if name in ORDINALS:
        name = ORDINALS[name]
    return Address(number, direction, name, suffix, " ".join(words[:end]) if "".join(words[:end]) == name else name)


def parse(street: str | None, number: str | None = None, others: Sequence[str | None] = (), lexicon: Lexicon = NOTHING) -> Address:
    """The address of a record: of its street, or of another field where that states more of one."""
    best = parse_line(street, number, lexicon)
    if best.worth < 5:
        for other in others:
            if other and len(other) > 4:
                found = parse_line(other, number, lexicon)
                if found.worth > best.worth and (found.suffix or found.worth >= 5 or not best.name):
                    best = found
    return best


def city_words(city: str | None) -> list[str]:
    """The words of a city with its first word written out."""
    words = re.sub(r"[^a-zÀ-ɏ]+", " ", (city or "").lower()).split()
    return [CITY_WORD_OF.get(words[0], words[0]), *words[1:]] if len(words) > 1 else words


def zip_form(code: str | None) -> str:
    """The five digits of a zip, a lost leading zero put back; empty if it isn't one."""
    m = re.match(r"\s*(\d{4,5})(?:-\d{4})?\s*$", code or "")
    return m[1].zfill(5) if m else ""


def slips(name: str) -> int:
    """How many edits a city's name may have."""
    return 1 if len(name) < 6 else 2 if len(name) < 9 else 3


def letters(name: str) -> int:
    """The set of a name's characters, folded into the bits of a word."""
    mask = 0
    for c in set(name):
        mask |= 1 << ord(c) % 61
    return mask


def rated(edits: int, code: str, zips: Iterable[str]) -> tuple[float, int]:
    """How far a listed city is from a typed one: edits and how its zips agree, then the edits alone."""
    if not code:
        return edits + 1.5, edits
    if code in zips:
        return edits, edits
    return edits + (1 if any(sum(x != y for x, y in zip(code, z, strict=False)) <= 1 for z in zips) else 2), edits


class CityIndex:
    """Finds the listed city that a typed city, state and zip mean."""

    def __init__(self, rows: Iterable[tuple[str | None, str | None, str | None]]) -> None:
        """`rows`: zip, city and state of the reference."""
        self.by_zip: dict[str, set[tuple[str, str]]] = defaultdict(set)
        self.by_name: dict[str, set[tuple[str, str]]] = defaultdict(set)
        self.by_state: dict[str, set[tuple[str, str]]] = defaultdict(set)
        self.zips: dict[tuple[str, str], set[str]] = defaultdict(set)
        for code, city, state in rows:
            if city and state:
                key = (state.strip().upper(), "".join(city_words(city)))
                self.by_name[key[1]].add(key)
                self.by_state[key[0]].add(key)
                if code:
                    self.by_zip[code].add(key)
                    self.zips[key].add(code)
        self.everywhere = set().union(*self.by_state.values()) if self.by_state else set()
        self.letters = {name: letters(name) for name in self.by_name}
        self.known = lru_cache(200_000)(self._find)

    def find(self, city: str | None, state: str | None, code: str | None) -> str:
        """`STATE|city` of the listed city, or of the typed one if none is near; empty if nothing tells."""
        return self.known(city or "", (state or "").strip().upper(), zip_form(code))

    def _find(self, city: str, state: str, code: str) -> str:
        words = city_words(city)
        states = {s for s in self.by_state if s}
        if len(words) > 1 and words[-1].upper() in states and (not state or words[-1].upper() == state):
            state = state or words[-1].upper()
            words = words[:-1]
        name = "".join(words)
        if not name:
            near = {c for c in self.by_zip.get(code, ()) if not state or c[0] == state}
            return "|".join(next(iter(near))) if len(near) == 1 else ""
        if code and code in self.zips.get((state, name), ()):
            return f"{state}|{name}"  # nothing can be nearer
        pool = self.by_state.get(state) or (self.by_zip.get(code, set()) | self.by_name.get(name, set())) or self.everywhere
        most = slips(name)
        mask = letters(name)  # an edit changes two letters of the set at most
        scored = [(*rated(d, code, self.zips[key]), key) for key in pool if (mask ^ self.letters[key[1]]).bit_count() <= 2 * most and (d := distance(name, key[1], most)) <= most]
        scored.sort()
        if scored and (len(scored) == 1 or scored[0][:2] != scored[1][:2]):
            return "|".join(scored[0][2])
        return f"{state}|{name}"
