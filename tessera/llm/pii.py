"""Personal data: base patterns, and spans that a semi-Markov conditional random field adds.

The base patterns find e-mail addresses, IP addresses, card and phone numbers. The field knows secrets too (keys, tokens and
passwords of letters and digits). It looks at stretches of a text that hold digits or a written or spelled at sign, cuts them
into tokens and scores whole segments of up to LONGEST tokens by features of the segment (digits, groups, separators,
checksums, mix of characters, what stands before it). A dynamic program over the bounded segments jointly chooses boundaries
and kinds; base spans stay as they are, and stretches are cut at them. It is trained by likelihood on stretches whose
segments the base patterns mark (secrets: what is assigned to a name such as token or password), some of them rewritten in
other forms or places (spelled at signs, national phone numbers, secrets after other words), and on numbers put in their
places that are none (dates, times, account and book numbers, orders, digests); its spans that meet no base span are added.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds of the base patterns, and that which only the field finds.
BASE_KINDS = ("email", "ip", "card", "phone")
SECRET = len(BASE_KINDS)
KINDS = (*BASE_KINDS, "secret")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits matches from its start or not at all: the look-behind keeps long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Distinct texts that training reads at most (those of least hash with a digit or an at sign), and cases it learns from at
#: most (a random choice of the stretches and rewritten forms in them).
TRAIN_ROWS, TRAIN_CASES = 300, 1000
#: Characters of a segment at least, its tokens at most, and the log-odds against no entity that an added segment needs.
SHORTEST, LONGEST, MARGIN = 7, 28, 1.0
#: Groups of digits of a segment without letters at most.
GROUPS = 7


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from the at signs: a match
    starts where the run of characters before its at sign does, or where the match before it ends."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and _LOCAL.match(text, start - 1):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            out.append((start, host.end()))
        floor = host.end() if host else at + 1
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), leftmost non-overlapping per kind; matches that fail a kind's test are dropped without retry."""
    out = []
    if "@" in text:
        out += [(0, s, e) for s, e in emails(text)]
    if _DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                out.append((1, *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, *m.span()))
    return out


# ---------------------------------------------------------------- the field

_AT = r"(?:@|[(\[]\s?at\s?[)\]]|\sat\s)"
_DOT = r"(?:\.|\s?[(\[]\s?dot\s?[)\]]\s?|\sdot\s)"
_KEY = r"[A-Za-z0-9+/_=-]"
#: Stretches that can hold an entity; nothing outside them has a segment. Their lengths are bounded, so that a long text takes
#: time in proportion to its length: what is longer (a run of digits, a key of more than 512 characters) is seen in pieces.
STRETCH = re.compile(
    rf"[A-Za-z0-9._%+-]{{1,64}}\s?{_AT}\s?[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{1,63}}){{1,6}}"
    rf"|(?<!{_KEY})(?={_KEY}{{0,511}}[0-9])(?={_KEY}{{0,511}}[A-Za-z]){_KEY}{{16,512}}|[+(]?[0-9](?:[ ().+\-/]{{0,3}}[0-9]){{5,40}}"
)
#: What training takes for a secret: a key that is assigned to such a name.
SEED = re.compile(rf"(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|auth[_-]?key)[\"']?\s?[:=]\s?[\"']?(?={_KEY}{{0,511}}[0-9])(?={_KEY}{{0,511}}[A-Za-z])({_KEY}{{16,512}})", re.I)
#: What is written before secrets, and before digests and numbers that are none.
BEFORE_SECRET = ("password: ", "secret=", "api_key = '", "Authorization: Bearer ", "access key ")
BEFORE_DIGEST = ("commit ", "sha256:", "md5 ", "revision ", "build id ", "checksum = ", "at ", "")
#: What every stretch holds.
_HINT = re.compile(rf"[0-9]|@|[(\[]\s?at\s?[)\]]|\sat\s\s?[A-Za-z0-9-]{{1,63}}{_DOT}[A-Za-z0-9-]")
_TOKEN = re.compile(r"(?=[0-9]*[A-Za-z])(?=[A-Za-z]*[0-9])[A-Za-z0-9]{16,}|[0-9]+|[A-Za-z]+|\s+|.", re.S)
_CALL = re.compile(r"(?:tel|phone|call|fon|fax|mobile|móvil|tél)\W*$", re.I)
_GOES_ON = re.compile(rf"{_DOT}[A-Za-z0-9]|[A-Za-z0-9]|[ -]?[0-9]")
_NUMBER = re.compile(r"(?:\bid|\bno|\bnr|version|revision|commit|checksum|sha|sha1|sha256|md5|hash|\bv|isbn|issn|iban|ean|order|invoice|ref|item|article|artikel|rechnung|bestellung|commande|facture|pedido|factura)\W*$", re.I)
_SECRET = re.compile(r"(?:token|secret|key|passw(?:or)?d|pwd|auth|bearer)\W*$", re.I)
#: Forms of figures that are no personal data here: dates, times of day, account numbers of banks and numbers of books. A
#: segment's features tell which of them it meets; what that means is learned.
OTHERS = re.compile(
    r"(?<![0-9])(?P<date>(?:1[5-9]|20)[0-9]{2}([-/.])(?:0?[1-9]|1[0-2])\2(?:0?[1-9]|[12][0-9]|3[01])"
    r"|(?:0?[1-9]|[12][0-9]|3[01])([-/.] ?)(?:0?[1-9]|[12][0-9]|3[01])\3(?:1[5-9]|20)[0-9]{2})(?![0-9])"
    r"|(?<![0-9:])(?P<clock>(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9])?)(?![0-9])"
    r"|(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?)(?![A-Za-z0-9])"
    r"|(?<![0-9])(?P<isbn>97[89](?:[- ]?[0-9]){9}[- ]?[0-9X])(?![0-9])"
)
_DIGITS = re.compile(r"[0-9]+")
_NO_KEY = re.compile(r"[^A-Za-z0-9+/_=-]")
_HAS_AT = re.compile(_AT)
_FORM = str.maketrans("0123456789", "1111111111")
#: What is written before phone numbers, and before numbers that are none.
BEFORE_PHONE = ("call ", "Call ", "tel. ", "Tel: ", "phone: ", "mobile ", "fax ")
BEFORE_NUMBER = ("order ", "invoice no. ", "ref: ", "id ", "ISBN ", "IBAN ", "article ", "version ", "item ")


def _figures(draw: random.Random, form: str) -> str:
    """The form with each # as a random digit and each 9 as one from 1."""
    return "".join(str(draw.randrange(10)) if c == "#" else str(draw.randrange(1, 10)) if c == "9" else c for c in form)


def national(draw: random.Random) -> str:
    """A phone number without a country's code."""
    return _figures(draw, draw.choice(("09# #######", "09## ######", "09##-#######", "09##/######", "(09#) ### ## ##", "(09##) ######", "09 ## ## ## ##", "09# ### ####", "09########", "9## ### ####", "(9##) ###-####", "9##-###-####")))


def no_entity(draw: random.Random) -> tuple[str, str]:
    """What may stand before a number that is no personal data, and the number."""
    day, month, year = draw.randrange(1, 29), draw.randrange(1, 13), draw.randrange(1900, 2040)
    clock = f"{draw.randrange(24):02d}:{draw.randrange(60):02d}" + draw.choice(("", f":{draw.randrange(60):02d}"))
    mark = draw.choice("-/.")
    date = draw.choice((f"{year}{mark}{month:02d}{mark}{day:02d}", f"{day:02d}{mark}{month:02d}{mark}{year}", f"{month}/{day}/{year}", f"{day}. {month}. {year}"))
    bank = draw.choice(("DE", "FR", "ES", "GB", "CZ")) + _figures(draw, draw.choice(("## #### #### #### #### ##", "####################")))
    book = draw.choice(("978", "979")) + _figures(draw, draw.choice(("-#-##-######-#", "-#-####-####-#", "##########")))
    free = ("", "on ", "at ", "of ")
    return draw.choice(
        (
            *((draw.choice(free), x) for x in (date, f"{date} {clock}", f"{date} {clock}", f"{clock} {date}")),
            (draw.choice(("", "IBAN ", "account ")), bank),
            (draw.choice(("", "ISBN ", "ISBN: ")), book),
            (draw.choice(BEFORE_NUMBER), _figures(draw, draw.choice(("9###-####-##", "9## ### ###", "9########", "9###-####", "9###.##.##", "0###-#####", "9##/####/##")))),
            (draw.choice(free), _figures(draw, draw.choice(("9## ### ###", "9 ### ###", "9# ### ### ###", "9#.9#.9#.9###", "9# 9# 9# 9#", "9### 9### 9###")))),
        )
    )


def free_stretches(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What lies between the base spans of the stretches of the text and of the stretches of what lies between them, where it
    is long enough for a segment; overlapping ones as one."""
    if not base:
        return [m.span() for m in STRETCH.finditer(text)]
    gaps, at = [], 0
    for _, a, b in sorted(base, key=lambda x: x[1:]):
        if a > at:
            gaps.append((at, a))
        at = max(at, b)
    gaps.append((at, len(text)))
    whole, first = [m.span() for m in STRETCH.finditer(text)], 0
    out: list[tuple[int, int]] = []
    for start, end in gaps:
        found = [m.span() for m in STRETCH.finditer(text, start, end)]
        while first < len(whole) and whole[first][1] <= start:
            first += 1
        k = first
        while k < len(whole) and whole[k][0] < end:
            found.append((max(whole[k][0], start), min(whole[k][1], end)))
            k += 1
        merged: list[tuple[int, int]] = []
        for a, b in sorted(found):
            if merged and a < merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        out += [(a, b) for a, b in merged if b - a >= SHORTEST]
    return out


def context(text: str, start: int) -> tuple[bool, bool, bool, bool]:
    """Whether a phone, another number or a secret is told before this place, and whether it stands within a word's marks."""
    before = text[max(0, start - 14) : start]
    joined = start > 0 and text[start - 1] in "@._%+-"
    if before.lower() == before.upper():
        return False, False, False, joined
    return bool(_CALL.search(before)), bool(_NUMBER.search(before)), bool(_SECRET.search(before)), joined


def around(told: tuple[bool, bool, bool, bool], goes_on: bool, edge: bool, other: str, kind: str) -> list[str]:
    """Names of the features of what stands around a segment."""
    call, number, secret, joined = told
    return [f"goes on={goes_on}&{joined}", f"inside={edge}", f"call={call}", f"number={number}", f"secret={secret}", f"other={other}&{kind}"]


@lru_cache(1 << 15)
def figure_features(form: str, zero: bool, octets: bool, checks: bool, told: tuple[bool, bool, bool, bool], goes_on: bool, edge: bool, other: str) -> list[str]:
    """Names of the features of a segment of digits and marks, which its form (each digit as 1) and what else is given decide."""
    groups = _DIGITS.findall(form)
    digits, first = sum([len(g) for g in groups]), form[0]
    marks = "".join(sorted(set(form) - {"1"})) or "none"
    out = [f"digits={min(digits, 20)}", f"groups={len(groups)}", f"marks={marks[:6]}", f"first={first if first in '+(' else '0' if zero else 'd'}"]
    out.append(f"shape={'-'.join([str(min(len(g), 9)) for g in groups[:6]])}")
    opens = zero or first in "+("
    out.append(f"opens={opens}&{told[0]}&{told[1]}")
    out.append(f"thousands={not opens and len(groups) > 1 and all([len(g) == 3 for g in groups[1:]])}")
    if len(groups) == 4:
        dots = form.count(".") == 3
        out.append(f"octets={dots and octets}&{dots}")
    if 13 <= digits <= 19:
        out.append(f"luhn={checks}")
    return [*out, f"closed={form.count('(') == form.count(')')}", *around(told, goes_on, edge, other, "digits")]


def segment_features(text: str, start: int, end: int, told: tuple[bool, bool, bool, bool], goes_on: bool, other: str, letters: bool = True) -> list[str]:
    """Names of a whole segment's features; `told` is the context of its start, `other` the form of OTHERS that it meets."""
    piece = text[start:end]
    edge = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    groups = _DIGITS.findall(piece)
    digits = "".join(groups)
    checks = 13 <= len(digits) <= 19 and luhn(digits)
    if not letters:
        octets = len(groups) == 4 and all([int(g[-4:]) <= 255 for g in groups])
        return figure_features(piece.translate(_FORM), piece[0] == "0", octets, checks, told, goes_on, edge, other)
    marks = "".join(sorted(set(re.sub(r"[0-9A-Za-z]", "", re.sub(r"^[^@]*@|^.*?[(\[\s]at\b", "@", piece))))) or "none"
    first = piece[0]
    out = [f"digits={min(len(digits), 20)}", f"groups={min(len(groups), 8)}", f"marks={marks[:6]}", f"first={first if first in '+(0' else 'd' if first.isdigit() else 'a'}", "letters"]
    if digits and not _NO_KEY.search(piece):
        cases = f"{bool(re.search('[a-z]', piece))}{bool(re.search('[A-Z]', piece))}"
        out.append(f"key={min(len(piece) // 8, 8)}&{cases}&{'hex' if re.fullmatch('[0-9a-fA-F]+', piece) else 'any'}")
        out.append(f"key after={told[2]}&{told[1]}")
        out.append(f"mixed={min(4 * len(digits) // len(piece), 3)}")
    else:
        ats = list(re.finditer(_AT, piece))
        out.append(f"at={len(ats)}&dots={min(len(re.findall(_DOT, piece[ats[-1].end() :] if ats else piece)), 3)}")
        out.append(f"host={bool(re.search(_AT + r'.*' + _DOT, piece))}")
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={checks}")
    return [*out, f"closed={piece.count('(') == piece.count(')')}", *around(told, goes_on, edge, other, "letters")]


class Lattice:
    """The tokens of a stretch and the segments that may be entities.

    A segment of digits and marks has 7 to 19 digits in at most GROUPS groups, or four groups and three dots; one with letters
    has a written or spelled at sign, four digits, or a digit in 16 characters. Counts of the segments come from prefix sums,
    so that a text of nothing but numbers takes a few segments a token."""

    def __init__(self, text: str, start: int, end: int):
        cuts = self.cuts = [start, *(start + m.end() for m in _TOKEN.finditer(text[start:end]))]
        self.n = n = len(cuts) - 1
        self.segments: list[tuple[int, int]] = []
        self.features: list[list[str]] = []
        # Before each cut: digits, groups of digits, letters and figures, letters (at signs too).
        sums = [(0, 0, 0, 0)]
        for k in range(n):
            d, g, m, c = sums[-1]
            token = text[cuts[k] : cuts[k + 1]]
            if token.isdigit():
                figures = alnum = len(token)
            else:
                figures, alnum = sum([ch.isdigit() for ch in token]), sum([ch.isalnum() for ch in token])
            sums.append((d + figures, g + (figures > 0), m + alnum, c + alnum - figures + (token == "@")))
        ends = [j for j in range(1, n + 1) if text[cuts[j] - 1].isalnum() or text[cuts[j] - 1] == ")"]
        goes_on = {j: bool(_GOES_ON.match(text, cuts[j])) for j in ends}
        origin = max(0, start - 24)
        others = [(origin + m.start(), origin + m.end(), m.lastgroup) for m in OTHERS.finditer(text[origin : end + 24])]
        low = 0
        for i in range(n):
            while low < len(ends) and ends[low] <= i:
                low += 1
            at = cuts[i]
            if not (text[at].isalnum() or text[at] in "+("):
                continue
            d0, g0, m0, c0 = sums[i]
            told = None
            for j in ends[low : low + LONGEST]:
                if j > i + LONGEST:
                    break
                d, g, m, c = sums[j]
                d, g, m, c = d - d0, g - g0, m - m0, c - c0
                size = cuts[j] - at
                if c == 0 and (g > GROUPS or d > 19):
                    # What follows could still reach an at sign or a letter.
                    if sums[-1][3] == c0:
                        break
                    continue
                if size < SHORTEST or (c == 0 and 2 * m < size):
                    continue
                if c == 0:
                    if d < 7 and not (g == 4 and text.count(".", at, cuts[j]) == 3):
                        continue
                elif d < 4 and not (size >= 16 and d) and not _HAS_AT.search(text, at, cuts[j]):
                    continue
                if told is None:
                    told = context(text, at)
                other = next((name for a, b, name in others if a < cuts[j] and at < b), "none") if others else "none"
                self.segments.append((i, j))
                self.features.append(segment_features(text, at, cuts[j], told, goes_on[j], other, c > 0))


class Field:
    """Weights by (feature, kind), the last row for features without one; a token outside entities scores 0."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, bias: np.ndarray):
        self.index, self.weights, self.bias = index, weights, bias

    def rows(self, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
        """The weights' rows of all segments' features, one after the other, and where each segment's begin."""
        none = len(self.index)
        flat = np.array([self.index.get(f, none) for fs in lattice.features for f in fs], np.int64)
        return flat, np.cumsum([0, *(len(fs) for fs in lattice.features[:-1])])

    def scores(self, lattice: Lattice, rows: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        if not lattice.features:
            return np.zeros((0, len(KINDS)))
        flat, starts = rows or self.rows(lattice)
        return self.bias + np.add.reduceat(self.weights[flat], starts, axis=0)

    def decode(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """(kind, start, end) of the best segmentation."""
        scores = self.scores(lattice) - MARGIN
        best, back = [0.0] * (lattice.n + 1), [None] * (lattice.n + 1)
        ending: dict[int, list[int]] = {}
        for k, (_, j) in enumerate(lattice.segments):
            ending.setdefault(j, []).append(k)
        for j in range(1, lattice.n + 1):
            best[j] = best[j - 1]
            for k in ending.get(j, ()):
                i, kind = lattice.segments[k][0], int(scores[k].argmax())
                if best[i] + scores[k, kind] > best[j]:
                    best[j], back[j] = best[i] + scores[k, kind], (i, kind)
        out, j = [], lattice.n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                i, kind = back[j]
                out.append((kind, lattice.cuts[i], lattice.cuts[j]))
                j = i
        return out[::-1]

    def extra(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans beside the base ones; none overlaps any of them."""
        if not _HINT.search(text):
            return []
        out = []
        for a, b in free_stretches(text, base):
            out += self.decode(Lattice(text, a, b))
        return out


def _logsum(x: list[float]) -> float:
    top = max(x)
    return top + float(np.log(sum(np.exp(v - top) for v in x)))


def train(texts: list[str], epochs: int = 10, rate: float = 0.5, ridge: float = 1e-3, seed: int = 5, most: int = TRAIN_CASES) -> Field:
    """Maximum likelihood by AdaGrad over stretches around base spans (entities) and other stretches (none), at most `most`
    of both, drawn by `seed`."""
    draw = random.Random(seed)
    cases: list[tuple[Lattice, set]] = []

    def add(text: str, gold: list[tuple[int, int, int]], a: int, b: int) -> None:
        lattice = Lattice(text, a, b)
        at = {c: k for k, c in enumerate(lattice.cuts)}
        wanted = {(at[s], at[e], kind) for kind, s, e in gold if s in at and e in at}
        spots = {(i, j): k for k, (i, j) in enumerate(lattice.segments)}
        if len(wanted) == len(gold) and all((i, j) in spots for i, j, _ in wanted):
            cases.append((lattice, {(spots[i, j], kind) for i, j, kind in wanted}))

    def spelled(at: str, dot: str):
        def form(s: str) -> str:
            local, host = s.split("@")
            local = draw.choice((local, re.sub("[^A-Za-z]", "", local) or local))
            host = draw.choice((host, ".".join(host.split(".")[-2:])))
            return local + at + host.replace(".", dot)

        return form

    rewrites = {
        0: (spelled(" [at] ", "."), spelled(" (at) ", " (dot) "), spelled(" [at] ", " [dot] "), spelled(" at ", " dot "), spelled(" @ ", ".")),
        3: (lambda s: re.sub(r"^\+[0-9]+[ -]?", "", s), lambda s: "00" + s[1:], lambda s: re.sub("[ ()]+", "-", s.lstrip("+")).strip("-")),
    }
    for text in texts:
        base = base_spans(text)
        for kind, s, e in base:
            # Where spans of two kinds overlap, the longer one is the entity.
            if any(a <= s and e <= b and b - a > e - s for _, a, b in base):
                continue
            left, piece, right = text[max(0, s - 40) : s], text[s:e], text[e : e + 20]
            forms = [(left, piece, True)] + [(left, f(piece), True) for f in rewrites.get(kind, ()) if draw.random() < 0.5]
            if kind == 3:
                forms += [(left + draw.choice(("", *BEFORE_PHONE)), national(draw), True) for _ in range(2)]
            # In the same place, numbers that are no entities.
            forms += [(left + words, number, False) for words, number in (no_entity(draw) for _ in range(1 + 2 * (kind == 3))) if not base_spans(number)]
            for before, form, entity in forms:
                around = before + form + right
                a, b = len(before), len(before) + len(form)
                m = next((m for m in STRETCH.finditer(around) if m.start() < b and a < m.end()), None)
                if m:
                    add(around, [(kind, a, b)] if entity else [], min(a, m.start()), max(b, m.end()))
        for m in SEED.finditer(text):
            s, e = m.span(1)
            if any(a < e and s < b for _, a, b in base):
                continue
            base.append((SECRET, s, e))
            # As it stands, after another word that tells a secret, and as a digest, which is none.
            cases_here = [(text[max(0, s - 40) : s], True), (draw.choice(BEFORE_SECRET), True), (draw.choice(BEFORE_DIGEST), False)]
            for left, secret in cases_here:
                around, a = left + text[s:e] + text[e : e + 20], len(left)
                add(around, [(SECRET, a, a + e - s)] if secret else [], a, a + e - s)
        spans = [(s, e) for _, s, e in base]
        for m in STRETCH.finditer(text):
            if not any(s < m.end() and m.start() < e for s, e in spans):
                add(text[max(0, m.start() - 40) : m.end() + 20], [], m.start() - max(0, m.start() - 40), m.end() - max(0, m.start() - 40))
    draw.shuffle(cases)
    cases = [c for c in cases if c[0].segments][:most]
    index = {f: k for k, f in enumerate(dict.fromkeys(f for lattice, _ in cases for fs in lattice.features for f in fs))}
    field = Field(index, np.zeros((len(index) + 1, len(KINDS))), np.zeros(len(KINDS)))
    squares, bias_squares = np.full(field.weights.shape, 1e-6), np.full(len(KINDS), 1e-6)
    prepared = []
    for lattice, gold in cases:
        by_end: dict[int, list[int]] = {}
        by_start: dict[int, list[int]] = {}
        for k, (i, j) in enumerate(lattice.segments):
            by_end.setdefault(j, []).append(k)
            by_start.setdefault(i, []).append(k)
        truth = np.zeros((len(lattice.segments), len(KINDS)))
        for k, kind in gold:
            truth[k, kind] = 1
        flat, starts = field.rows(lattice)
        owner = np.repeat(np.arange(len(lattice.features)), [len(fs) for fs in lattice.features])
        used, place = np.unique(flat, return_inverse=True)
        prepared.append((lattice, truth, by_end, by_start, (flat, starts), owner, used, place))
    for _ in range(epochs):
        for lattice, truth, by_end, by_start, rows, owner, used, place in prepared:
            scores = field.scores(lattice, rows)
            mass = np.logaddexp.reduce(scores, axis=1)
            ahead, behind = [0.0] * (lattice.n + 1), [0.0] * (lattice.n + 1)
            for j in range(1, lattice.n + 1):
                ahead[j] = _logsum([ahead[j - 1], *(ahead[lattice.segments[k][0]] + mass[k] for k in by_end.get(j, ()))])
            for i in range(lattice.n - 1, -1, -1):
                behind[i] = _logsum([behind[i + 1], *(behind[lattice.segments[k][1]] + mass[k] for k in by_start.get(i, ()))])
            around = np.array([ahead[i] + behind[j] for i, j in lattice.segments]) - ahead[-1]
            grad = truth - np.exp(np.minimum(around[:, None] + scores, 0))
            total = grad.sum(axis=0)
            bias_squares += total * total
            field.bias = field.bias + rate * total / np.sqrt(bias_squares)
            step = np.zeros((len(used), len(KINDS)))
            np.add.at(step, place, grad[owner])
            step -= ridge * field.weights[used]
            squares[used] += step * step
            field.weights[used] += rate * step / np.sqrt(squares[used])
    return field


def fit(docs: DataFrame, text_col: str = "text", rows: int = TRAIN_ROWS, most: int = TRAIN_CASES) -> Field:
    """Trains on at most `most` cases of at most `rows` distinct texts that hold a digit or an at sign, those of least hash,
    cut to what stands near their stretches. Copies of a text count once."""
    found = docs.select(F.col(text_col).cast("string").alias("text")).filter(F.col("text").rlike("[0-9@]")).withColumn("h", F.xxhash64("text"))
    picked = [r["h"] for r in found.select("h").distinct().orderBy("h").limit(rows).collect()]
    near = F.array_join(F.regexp_extract_all("text", F.lit(r"(?s).{0,40}[0-9@].{0,60}"), 0), "\n")
    sample = found.filter(F.col("h").isin(picked)).groupBy("h").agg(F.min(near).alias("near")).collect()
    return train([r["near"] for r in sorted(sample, key=lambda r: r["h"])], most=most)


def digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row of docs.

    Counts and the digest are of the base spans, spans holds these and the added ones (those of secrets last); offsets are
    code points. Null and
    empty texts have none (the digest is that of an empty string). Long texts are read whole; repeated rows give equal
    rows; an empty table gives an empty result; other columns are ignored."""
    names = ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"]
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sha, spans = [[] for _ in BASE_KINDS], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                base = base_spans(text)
                for k, c in enumerate(counts):
                    c.append(sum(s[0] == k for s in base))
                sha.append(hashlib.sha256(digest(base).encode()).hexdigest() if base else nothing)
                spans.append(digest([*base, *field.extra(text, base)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string"
    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, schema)


def redact(text: str, field: Field) -> str:
    """The text with every span, base or added, replaced by its kind in brackets."""
    base = base_spans(text)
    spans = sorted((s, e, k) for k, s, e in [*base, *field.extra(text, base)])
    out, at = [], 0
    for s, e, k in spans:
        if e <= at:
            continue
        out += [text[at:s], f"[{KINDS[k].upper()}]"] if s >= at else []
        at = e
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """docs with personal data replaced in text; null stays null, other columns stay as they are."""
    names, at = docs.columns, docs.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redact(t, field) for t in (x.as_py() for x in batch.column(at))]
            columns = [pa.array(texts, pa.string()) if k == at else c for k, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)
