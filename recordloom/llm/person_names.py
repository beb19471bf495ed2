"""Reading names of persons as people type them: order, initials, nicknames, suffixes, ranks, countries."""

from __future__ import annotations

import re
from collections.abc import Iterable

from recordloom.functions.text import fold, squash

# Given names and the short forms in use for them.
SHORT_FORMS = {
    "alexander": "alex sasha sacha xander lex sandro", "alexandra": "alex sasha sandra alexa lexi", "amanda": "mandy manda", "andrei": "andy andre andriy andrey",
    "anthony": "tony ant", "antonio": "tony toni toninho", "benjamin": "ben benny benji", "christopher": "chris kit topher", "daniel": "dan danny dani",
    "dmitri": "dima mitya dimi dmitry dimitri", "eduardo": "edu dudu eddie ed lalo", "ekaterina": "katya kate katia", "elizabeth": "liz beth lizzie betty eliza lisa",
    "fernando": "nando fer", "francisco": "paco chico pancho fran cisco kiko", "francois": "fran franck", "gabriela": "gabi gaby gabe", "gianni": "gian giovanni",
    "gregory": "greg", "henrik": "rik henry henke", "jennifer": "jen jenny jenn", "jessica": "jess jessie", "jesus": "chuy chucho", "jose": "pepe zeca ze",
    "joseph": "joe joey jo", "juliana": "juli ju jules", "katherine": "kate kathy katie kat kit", "krzysztof": "krzys krzysiek chris kris", "laurent": "lolo laurie",
    "leonardo": "leo", "lukasz": "luk lukas", "lukas": "luke luk", "mariana": "mari mary", "mateus": "mat teus matt", "matthew": "matt matty mat", "michael": "mike mick mickey mikey",
    "mikhail": "misha mike", "natalia": "nat natasha nata", "nicholas": "nick nicky nico nik", "oskar": "ossi oz", "paulo": "paulinho", "rafael": "rafa rafi raf rafinha", "ramon": "moncho ray",
    "rebecca": "becky becca", "robert": "bob rob bobby robbie", "rodrigo": "rod digo rodri", "samantha": "sam sammy", "samuel": "sam sammy", "sergei": "serge seryozha serg sergey",
    "stefan": "stef steve", "stephanie": "steph stef", "svetlana": "sveta lana", "tereza": "terka tess", "thomas": "tom tommy", "tiago": "ti thiago", "tomasz": "tomek tom",
    "valentina": "vale val tina", "victoria": "vicky vic tori", "viktor": "vitya vic vik", "vladimir": "vlad vova volodya", "weronika": "wera nika", "william": "bill will willy billy liam",
    "yannick": "yan yann", "zoltan": "zoli", "agnieszka": "aga", "aigerim": "aika", "karolina": "karo kara lina", "priscila": "pri cila", "ondrej": "ondra", "pavel": "pasha pavlik",
    "marco": "marcao", "marek": "mara", "ivan": "vanya", "gabriel": "gabe gabi", "jerome": "jerry", "angus": "gus", "bogdan": "bodya", "camille": "cam", "ingrid": "inga", "lars": "lasse", "radu": "raducu",
    "giorgi": "gio george", "oscar": "ozzy", "timur": "tima", "raul": "raulito", "larissa": "lara", "giulia": "giuly julia", "luca": "luk", "takeshi": "take", "hiroshi": "hiro", "daichi": "dai",
}
_FORMAL: dict[str, tuple[str, ...]] = {}
for _name, _shorts in SHORT_FORMS.items():
    for _short in _shorts.split():
        _FORMAL[_short] = (*_FORMAL.get(_short, ()), _name)
# Words that begin a surname, and suffixes that follow one.
PARTICLES = frozenset("van von der den de da do dos di del della la le st ter ten bin al el ben mac mc o".split())
SUFFIXES = frozenset("jr sr ii iii iv junior senior filho neto".split())
# What is typed where nobody is known yet.
PLACEHOLDERS = frozenset("tba tbd tbc unknown opponenttba opponenttbd tobeannounced tobedetermined opponent na none fighter noopponent nn x xx mysteryopponent".split())
_RANK = re.compile(r"\s*#\s*\d+.*$")
_BRACKET = re.compile(r"[\(\[]([^\)\]]*)[\)\]]")
_QUOTED = re.compile(r"[\"“”„«»](.+?)[\"“”„«»]|(?<!\w)['‘’](\S[^'‘’]*?)['‘’](?!\w)")
_RELATED = re.compile(r"\b(?:brother|sister|cousin|son|daughter|father|mother|wife|husband|frere|soeur|fils|hermano|irmao) (?:of|de)\b|\bthe (?:younger|elder)\b|'s (?:brother|sister|cousin|son|daughter)", re.I)


class Name:
    """What a typed name says: nickname, suffix, and its readings `(given, surname)` in squashed letters."""

    __slots__ = ("nickname", "junior", "readings", "whole", "words")

    def __init__(self, nickname: str, junior: bool, readings: list[tuple[str, str]], whole: str, words: list[str]):
        self.nickname, self.junior, self.readings, self.whole, self.words = nickname, junior, readings, whole, words


def read_name(text: str | None, givens: frozenset[str] = frozenset()) -> Name | None:
    """The readings of a name; None for placeholders and texts without letters. `givens` are known given names."""
    if not text:
        return None
    s = _RANK.sub("", text.strip())
    nickname = ""
    for m in _QUOTED.finditer(s):
        nickname = squash(m.group(1) or m.group(2))
    s = _QUOTED.sub(" ", s)
    for m in _BRACKET.finditer(s):
        inner = m.group(1).strip()
        if len(inner) > 3 or not inner.isupper():
            nickname = nickname or (squash(inner) if len(squash(inner)) > 2 else "")
    s = fold(_BRACKET.sub(" ", s)).replace("*", " ").replace("_", " ").lower()
    s = re.sub(r"\b([a-z])\.(?=[^\s])", r"\1. ", s)
    family, comma, rest = s.partition(",")
    if comma and squash(rest) in SUFFIXES:
        s, comma = family + " " + rest, ""
    words = [w for w in s.replace(",", " ").split() if squash(w)]
    junior = any(squash(w) in SUFFIXES for w in words[1:])
    words = [w for i, w in enumerate(words) if i == 0 or squash(w) not in SUFFIXES]
    whole = squash("".join(words))
    if not whole or whole in PLACEHOLDERS or whole.isdigit():
        return None
    readings: list[tuple[str, str]] = []

    def add(given: list[str], surname: list[str]) -> None:
        g = squash(given[0]) if given else ""
        surname = [w for w in surname if len(squash(w)) > 1 or squash(w) == "o"] or surname
        r = (g, squash("".join(surname)))
        if r[1] and r not in readings:
            readings.append(r)

    if comma:
        f = [w for w in family.split() if squash(w) and squash(w) not in SUFFIXES]
        g = [w for w in rest.split() if squash(w) and squash(w) not in SUFFIXES]
        if f and g:
            add(g, f)
    if not readings and len(words) >= 2:
        first, last = squash(words[0]), squash(words[-1])
        forward = first in givens or first in _FORMAL
        backward = last in givens or last in _FORMAL or len(last) == 1
        if len(first) == 1 and len(last) > 1:
            add(words[:1], words[1:])
        elif forward or not backward:
            add(words[:1], words[1:])
            if not forward:
                add(words[-1:], words[:-1])
        else:
            add(words[-1:], words[:-1])
            if first not in PARTICLES and len(last) > 1 and not last in givens:
                add(words[:1], words[1:])
    if len(words) == 1:
        add([], words)
    elif not nickname and len(words) >= 2:
        nickname = squash("".join(words[:-1]))
    return Name(nickname, junior, readings, whole, [squash(w) for w in words])


def formal_names(given: str, hyphenated: dict[str, tuple[str, ...]] | None = None) -> tuple[str, ...]:
    """Given names a short form may stand for."""
    return _FORMAL.get(given, ()) + (hyphenated or {}).get(given, ())


def is_relative(text: str) -> bool:
    """Whether a name points to a relative of the person it holds."""
    return bool(_RELATED.search(text))


def halves(givens: Iterable[str]) -> dict[str, tuple[str, ...]]:
    """First halves of hyphenated given names (as typed) and the names they stand for."""
    out: dict[str, tuple[str, ...]] = {}
    for g in givens:
        if "-" in g:
            first = squash(g.split("-")[0])
            out[first] = (*out.get(first, ()), squash(g))
    return out


def _edits(a: str, b: str, limit: int) -> int:
    """Levenshtein distance, `limit + 1` beyond the limit."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        if min(row) > limit:
            return limit + 1
    return min(row[-1], limit + 1)


def may_be_same(a: Name | None, b: Name | None, givens: frozenset[str], parts: dict[str, tuple[str, ...]] | None = None) -> bool:
    """Whether two names may be one person's: surnames within two edits, given names equal, short, initial or misspelled.

    Two different common given names are two persons."""
    if a is None or b is None:
        return False
    if a.whole == b.whole:
        return True
    for g, s in a.readings:
        for h, t in b.readings:
            limit = 2 if min(len(s), len(t)) > 4 else 0
            near = _edits(s, t, limit)
            if near > limit:
                continue
            forms_g, forms_h = {g, *formal_names(g, parts)}, {h, *formal_names(h, parts)}
            if forms_g & forms_h:
                return True
            if g[:1] == h[:1] and (len(g) == 1 or len(h) == 1) and near <= 1:
                return True
            if not (g in givens and h in givens) and _edits(g, h, 2) + near <= 3 and _edits(g, h, 2) <= 2:
                return True
    last = lambda n: n.words[-1] if n.words else ""
    nick_a, nick_b = a.nickname, b.nickname
    return bool(nick_a and nick_a == nick_b and last(a) == last(b) and nick_a != last(a))
