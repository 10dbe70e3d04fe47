"""Private data replaced by format-preserving pseudonyms.

What looks like private data is checked (card numbers by their check digit, account numbers modulo 97,
dates by the calendar, network addresses by their ranges); every number in a phone format counts. A valid value is a number within
the set of all valid values of its format; a keyed Feistel network permutes that set, and the image is
written in the same format. Equal values get equal pseudonyms in every document and every run with the
same key, also where only the separators differ; different values get different ones. A date is one value
however it is written, and so is an IPv6 address; a national phone number and its international form are two.
Secrets and addresses have any length: long ones are permuted in blocks, each chained to those before it.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.shared import id_and_text, slices

ROUNDS = 8


def _round(key: bytes, tweak: bytes, n: int, r: int, half: int, bits: int) -> int:
    message = b"%b|%d|%d|%d" % (tweak, n, r, half)
    return int.from_bytes(hashlib.blake2b(message, key=key, digest_size=16).digest(), "big") & ((1 << bits) - 1)


def _network(key: bytes, tweak: bytes, n: int, x: int, rounds: Iterable[int], bits: int, back: bool) -> int:
    left, right = x >> bits, x & ((1 << bits) - 1)
    for r in rounds:
        if back:
            left, right = right ^ _round(key, tweak, n, r, left, bits), left
        else:
            left, right = right, left ^ _round(key, tweak, n, r, right, bits)
    return left << bits | right


def feistel(key: bytes, tweak: bytes, n: int, x: int, back: bool = False) -> int:
    """A keyed permutation of ``range(n)``: a balanced Feistel network, walked until it is back in the range."""
    bits = max(1, ((n - 1).bit_length() + 1) // 2)
    rounds = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    while True:
        x = _network(key, tweak, n, x, rounds, bits, back)
        if x < n:
            return x


def permute(key: bytes, tweak: str, n: int, x: int, back: bool = False) -> int:
    """A keyed permutation of ``range(n)`` that leaves no value where it was.

    One step along a cycle through all values, in the secret order that the Feistel network gives them.
    """
    mark = tweak.encode()
    step = -1 if back else 1
    return feistel(key, mark, n, (feistel(key, mark, n, x) + step) % n, back=True) if n > 1 else x


# What the formats allow.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
HEX_DIGITS = "0123456789abcdef"
MONTHS = {
    "en": "January February March April May June July August September October November December",
    "short": "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec",
    "de": "Januar Februar März April Mai Juni Juli August September Oktober November Dezember",
    "fr": "janvier février mars avril mai juin juillet août septembre octobre novembre décembre",
    "es": "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre",
}
MONTH_LISTS = [names.split() for names in MONTHS.values()]
MONTH = "|".join(sorted({name for names in MONTH_LISTS for name in names}, key=lambda name: (-len(name), name)))
HEX_GROUP = "[0-9a-fA-F]{1,4}"
BLOCK = 24  # letters that are permuted together


def _marks() -> str:
    """The combining marks of the basic plane as ranges of a character class: part of a letter, but not of ``\\w``."""
    ranges: list[list[int]] = []
    for c in range(0x300, 0x10000):
        if unicodedata.category(chr(c))[0] == "M":
            if ranges and ranges[-1][1] == c - 1:
                ranges[-1][1] = c
            else:
                ranges.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges)


MARKS = _marks()
PATTERNS = {
    "email": rf"(?<![\w{MARKS}.%+-])(?P<local>[\w{MARKS}.%+-]++)@(?P<host>[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})",
    "access_key": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "password": r"(?i:(?<![a-z])(?:password|passwd|pwd)\s?[=:]\s?)(?P<secret>[^\s\"',;]++)",
    "token": r"(?<![A-Za-z0-9])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "iso_date": r"(?<![\d.-])(?P<y1>\d{4})(?P<s1>[-/.])(?P<m1>\d{1,2})(?P=s1)(?P<d1>\d{1,2})(?![\d.-]?\d)",
    "day_date": r"(?<![\d./-])(?P<a2>\d{1,2})(?P<s2>[-/.])(?P<b2>\d{1,2})(?P=s2)(?P<y2>\d{4})(?![\d./-]?\d)",
    "name_date": rf"(?<![\w.,/-])(?P<d3>[0-9]{{1,2}})(?P<o3>st|nd|rd|th)?(?P<s3>\.?[ -]| de | of )(?P<n3>(?i:{MONTH}))(?P<t3>[.,]?[ -]| de )(?P<y3>[0-9]{{4}})(?!\w)",
    "month_date": rf"(?<!\w)(?P<n4>(?i:{MONTH}))(?P<s4>\.? )(?P<d4>[0-9]{{1,2}})(?P<o4>st|nd|rd|th)?(?P<t4>,? )(?P<y4>[0-9]{{4}})(?!\w)",
    "ip6": rf"(?<![\w:])(?:(?:{HEX_GROUP}:){{7}}{HEX_GROUP}|(?:{HEX_GROUP}:){{1,6}}(?::{HEX_GROUP}){{1,6}}|(?:{HEX_GROUP}:){{2,7}}:)(?![\w:])",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}(?P<s5>[- ])\d{2}(?P=s5)\d{4}(?!-?\d)(?!(?P=s5)\d)",
    "phone": r"(?<![\d+])(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)|(?<![\w.,-])\d{10}(?![\w-]|[.,]\d))",
    "abroad": r"(?<![\d+])\+(?P<land>[2-9]\d{0,2})(?:[ .-]?\(?\d{1,4}\)?){2,6}(?!\d)",
    "national": r"(?<![\w+.,/:-])\(?0[1-9]\d{0,3}\)?(?:[ .-]?\d{2,4}){2,4}(?![\w-]|[ .,/:]?\d)",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![.-]?\d)",
}
KINDS = list(PATTERNS)
# digits of other scripts are in none of these formats
PATTERNS |= {kind: f"(?a:{PATTERNS[kind]})" for kind in KINDS if kind not in ("email", "password", "name_date", "month_date")}
ANY = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in PATTERNS.items()))
READ = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
# groups of digits that the card pattern may join, and how the groups of a card are written, likeliest first
RUN, GROUP, DECIMAL = re.compile(r"[0-9]+(?:[ -][0-9]+)*"), re.compile("[0-9]+"), re.compile(r"\.[0-9]")
CARD_FORMS = [re.compile(p) for p in (r"\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{4,5}|\d{13,19}", r"\d{4}([ -])\d{3}\1\d{3}\1\d{3}|(?:\d{4,}[ -])+\d{3,}")]
# nothing of the above without one of these
TRIGGER = "[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd)"


def luhn_digit(digits: str) -> str:
    """The check digit that belongs after ``digits``."""
    total = 0
    for k, d in enumerate(reversed(digits)):
        twice = int(d) * (2 if k % 2 == 0 else 1)
        total += twice - 9 if twice > 9 else twice
    return str(-total % 10)


@functools.lru_cache(1000)
def _alike(page: int, lower: bool, upper: bool) -> str:
    """The letters and digits of 256 code points that are of one case."""
    chars = map(chr, range(page << 8, page + 1 << 8))
    return "".join(c for c in chars if c.isalnum() and (c.islower(), c.isupper()) == (lower, upper))


def iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4]))


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _refill(form: str, digits: str) -> str:
    """``form`` with its digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c in DIGITS else c for c in form)


def _mixed(radices: list[int], values: list[int]) -> tuple[int, int]:
    """Size of a mixed-radix domain and the place of ``values`` in it."""
    x = 0
    for r, v in zip(radices, values, strict=True):
        x = x * r + v
    return math.prod(radices), x


def _unmixed(radices: list[int], x: int) -> list[int]:
    values = []
    for r in reversed(radices):
        x, v = divmod(x, r)
        values.append(v)
    return values[::-1]


@dataclass(frozen=True)
class Pseudonyms:
    """Pseudonyms under one key. ``of`` gives the pseudonym of a match, or None if it is not valid."""

    key: bytes

    def _place(self, tweak: str, radices: list[int], values: list[int]) -> list[int]:
        n, x = _mixed(radices, values)
        return _unmixed(radices, permute(self.key, tweak, n, x))

    def _letters(self, tweak: str, text: str, sets: Iterable[str] = (LOWER, UPPER, DIGITS)) -> str:
        """Every character of a set stays in its set; others stay. Blocks after the first depend on all before them."""
        sets = tuple(sets)
        of = [next((s for s in sets if c in s), None) for c in text]
        out, chain = list(text), hashlib.blake2b(key=self.key, digest_size=16)
        places = [k for k, s in enumerate(of) if s]
        for first in range(0, max(1, len(places)), BLOCK):
            block = places[first : first + BLOCK]
            # a block reaches to the next one, with what stays in between
            a = block[0] if first else 0
            b = places[first + BLOCK] if first + BLOCK < len(places) else len(text)
            form = "".join("x" if s is None else str(sets.index(s)) if s.isascii() else f"{s[0]}." for s in of[a:b])
            mark = f"{tweak}|{form}|{chain.hexdigest()}" if first else f"{tweak}|{form}"
            for k, v in zip(block, self._place(mark, [len(of[k]) for k in block], [of[k].index(text[k]) for k in block]), strict=True):
                out[k] = of[k][v]
            chain.update(f"{tweak}|{text[a:b]}|".encode())
        return "".join(out)

    def _scripts(self, tweak: str, text: str) -> str:
        """Letters stay in their script and case, digits digits."""
        others = dict.fromkeys(_alike(ord(c) >> 8, c.islower(), c.isupper()) for c in text if c.isalnum() and not c.isascii())
        # letters of other scripts stay among those of their page and case, without the ASCII ones
        sets = (LOWER, UPPER, DIGITS, *("".join(c for c in s if not c.isascii()) for s in sorted(others)))
        return self._letters(tweak, text, sets)

    def email(self, m: re.Match) -> str | None:
        local, host = m["local"], m["host"]
        if not any(c.isalnum() for c in local):
            return None
        return f"{self._scripts('email|' + host.lower(), local)}@{host}"

    def access_key(self, m: re.Match) -> str:
        text = m.group()
        return text[:4] + self._letters("access", text[4:], (UPPER + DIGITS,))

    def password(self, m: re.Match) -> str:
        return m.group()[: m.start("secret") - m.start()] + self._scripts("password", m["secret"])

    def token(self, m: re.Match) -> str:
        return self._letters("token", m.group(), (HEX_DIGITS,))

    def iban(self, m: re.Match) -> str | None:
        text = m.group()
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or iban_number(plain) % 97 != 1:
            return None
        new = self._letters(f"iban|{plain[:2]}", plain[4:], (UPPER, DIGITS))
        check = 98 - iban_number(plain[:2] + "00" + new) % 97
        out = iter(f"{plain[:2]}{check:02d}{new}")
        return "".join(c if c == " " else next(out) for c in text)

    def _day(self, year: str, month: str, day: str) -> date | None:
        try:
            found = date(int(year), int(month), int(day))
        except ValueError:
            return None
        if not FIRST_DAY <= found <= LAST_DAY:
            return None
        n = (LAST_DAY - FIRST_DAY).days + 1
        return FIRST_DAY + timedelta(permute(self.key, "date", n, (found - FIRST_DAY).days))

    def iso_date(self, m: re.Match) -> str | None:
        new = self._day(m["y1"], m["m1"], m["d1"])
        wide = min(len(m["m1"]), len(m["d1"]))
        return new and f"{new.year:04d}{m['s1']}{new.month:0{wide}d}{m['s1']}{new.day:0{wide}d}"

    def day_date(self, m: re.Match) -> str | None:
        """Day first; month first where only that is a date."""
        a, b, s = m["a2"], m["b2"], m["s2"]
        wide = min(len(a), len(b))
        if new := self._day(m["y2"], b, a):
            return f"{new.day:0{wide}d}{s}{new.month:0{wide}d}{s}{new.year:04d}"
        new = self._day(m["y2"], a, b)
        while new and new.day <= 12:  # stays a date that only reads month first
            new = self._day(str(new.year), str(new.month), str(new.day))
        return new and f"{new.month:0{wide}d}{s}{new.day:0{wide}d}{s}{new.year:04d}"

    def _named_day(self, name: str, day: str, ordinal: str | None, year: str) -> tuple[str, str, int] | None:
        """Month, day and year of the pseudonym, written as the given ones are."""
        names = next(some for some in MONTH_LISTS if name.lower() in map(str.lower, some))
        new = self._day(year, str([x.lower() for x in names].index(name.lower()) + 1), day)
        if new is None:
            return None
        month = names[new.month - 1]
        month = month.lower() if name.islower() else month.upper() if name.isupper() else month.capitalize()
        number = f"{new.day:02d}" if day[0] == "0" else str(new.day)
        if ordinal:
            number += "th" if new.day in (11, 12, 13) else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
        return month, number, new.year

    def name_date(self, m: re.Match) -> str | None:
        new = self._named_day(m["n3"], m["d3"], m["o3"], m["y3"])
        return new and f"{new[1]}{m['s3']}{new[0]}{m['t3']}{new[2]:04d}"

    def month_date(self, m: re.Match) -> str | None:
        new = self._named_day(m["n4"], m["d4"], m["o4"], m["y4"])
        return new and f"{new[0]}{m['s4']}{new[1]}{m['t4']}{new[2]:04d}"

    def ip6(self, m: re.Match) -> str | None:
        """Groups of zeros stay, so that short and long forms of an address get the same pseudonym."""
        text = m.group()
        head, short, tail = text.partition("::")
        written = [head.split(":") if head else [], tail.split(":") if tail else []]
        left = 8 - len(written[0]) - len(written[1])
        if short and (left < 1 or len(text.strip(":").split(":")) < 4 and not any(c in DIGITS for c in text)):
            return None
        groups = [int(x, 16) for x in written[0] + ["0"] * left + written[1]]
        taken = [k for k, g in enumerate(groups) if g]
        if not taken:
            return None
        form = "".join("0" if not g else "x" for g in groups)
        new = dict(zip(taken, self._place(f"ip6|{form}", [0xFFFF] * len(taken), [groups[k] - 1 for k in taken]), strict=True))
        wide = 4 if all(len(x) == 4 for side in written for x in side) else 1
        out = [f"{new[k] + 1 if k in new else 0:0{wide}x}" for k in range(8)]
        if text != text.lower():
            out = [x.upper() for x in out]
        return ":".join(out[: len(written[0])]) + short + ":".join(out[8 - len(written[1]) :] if short else [])

    def ip(self, m: re.Match) -> str | None:
        octets = [int(x) for x in m.group().split(".")]
        if max(octets) > 255:
            return None
        return ".".join(map(str, self._place("ip", [256] * 4, octets)))

    def ssn(self, m: re.Match) -> str | None:
        sep = m["s5"]
        area, group, serial = map(int, m.group().split(sep))
        if area in (0, 666) or area >= 900 or not group or not serial:
            return None
        # areas 1 to 899 without 666
        a, g, s = self._place("ssn", [898, 99, 9999], [area - 1 - (area > 666), group - 1, serial - 1])
        return f"{a + 1 + (a >= 665):03d}{sep}{g + 1:02d}{sep}{s + 1:04d}"

    def phone(self, m: re.Match) -> str:
        digits = _digits(m.group())
        lead, digits = digits[:-10], digits[-10:]
        area, exchange, line = int(digits[:3]), int(digits[3:6]), int(digits[6:])
        # below 200 no area code or exchange is given out; what is written so keeps to that
        from_a, from_e = 200 * (area >= 200), 200 * (exchange >= 200)
        tweak = "phone" if from_a and from_e else f"phone|{from_a}|{from_e}"
        a, e, n = self._place(tweak, [800 if from_a else 200, 800 if from_e else 200, 10_000], [area - from_a, exchange - from_e, line])
        return _refill(m.group(), f"{lead}{a + from_a:03d}{e + from_e:03d}{n:04d}")

    def abroad(self, m: re.Match) -> str | None:
        digits, land = _digits(m.group()), m["land"]
        if not 8 <= len(digits) <= 15:
            return None
        rest = digits[len(land) :]
        new = permute(self.key, f"abroad|{land}|{len(rest)}", 10 ** len(rest), int(rest))
        return _refill(m.group(), f"{land}{new:0{len(rest)}d}")

    def national(self, m: re.Match) -> str | None:
        """A number with the leading zero of national calls, which stays."""
        digits = _digits(m.group())
        if not 9 <= len(digits) <= 11 or m.group().count("(") != m.group().count(")"):
            return None
        # the digit after the zero is none
        first, rest = self._place(f"national|{len(digits)}", [9, 10 ** (len(digits) - 2)], [int(digits[1]) - 1, int(digits[2:])])
        return _refill(m.group(), f"0{first + 1}{rest:0{len(digits) - 2}d}")

    def card(self, m: re.Match) -> str | None:
        """The first digit, which tells the brand, stays; the check digit follows from the others."""
        digits = _digits(m.group())
        if luhn_digit(digits[:-1]) != digits[-1] or not digits.strip("0"):
            return None
        free = digits[1:-1]
        new = permute(self.key, f"card|{digits[0]}|{len(digits)}", 10 ** len(free), int(free))
        head = f"{digits[0]}{new:0{len(free)}d}"
        return _refill(m.group(), head + luhn_digit(head))

    def _card_within(self, text: str, here: re.Match, to: int, loose: bool) -> tuple[int, int, str] | None:
        """Start, end and pseudonym of the likeliest card among the groups of a card match and those that follow it.

        Parts of the match have to be grouped as cards are; all of it may be in any groups if ``loose``.
        """
        start, end = here.span()
        groups = [g.span() for g in GROUP.finditer(text, start, RUN.match(text, start, min(to, end + 20)).end())]
        best = None
        for i, (a, z) in enumerate(groups):
            if a >= end:
                break
            whole = loose and a == start
            if z - a < 4 and not whole:
                continue
            n = 0
            for first, b in groups[i:]:
                n += b - first
                if n > 19:
                    break
                if n < 13 or b > end and (text[b : b + 1].isdigit() or DECIMAL.match(text, b, to)):
                    continue
                rank = next((k for k, form in enumerate(CARD_FORMS) if form.fullmatch(text, a, b)), len(CARD_FORMS))
                if rank == len(CARD_FORMS) and not (whole and b == end):
                    continue
                new = self.card(READ["card"].fullmatch(text[a:b]))
                if new is not None and (best is None or (rank, -n) < best[0]):
                    best = (rank, -n), (a, b, new)
        return best and best[1]

    def _shorter(self, kind: str, text: str, here: re.Match, to: int) -> tuple[int, int, str] | None:
        """The longest valid form of a match that ends before one of its groups, and before a card."""
        start, end = here.span()
        if kind == "abroad" and (digits := GROUP.search(text, start)):
            for group in GROUP.finditer(text, digits.end(), end):
                card = READ["card"].match(text, group.start(), to)
                if card and (found := self._card_within(text, card, to, False)):
                    end = min(end, found[0])
        for b in range(end - 1, start, -1):
            if text[b] in " .-" and (m := READ[kind].fullmatch(text, start, b)) and (new := getattr(self, kind)(m)) is not None:
                return start, b, new
        return None

    def _find(self, text: str, at: int, to: int) -> Iterator[tuple[str, int, int, str]]:
        """Kind, start, end and pseudonym of what is valid from ``at`` to ``to``.

        Where a match is not valid, other kinds and shorter forms at its place are tried, then the next places.
        """
        failed = at  # the end of the card matches that were not valid
        while m := ANY.search(text, at, to):
            start = m.start()
            at = start + 1
            first = next(k for k, kind in enumerate(KINDS) if m[kind] is not None)
            for kind in KINDS[first:]:
                here = m if kind == KINDS[first] else READ[kind].match(text, start, to)
                if not here:
                    continue
                if kind == "card":
                    found = self._card_within(text, here, to, start >= failed)
                    failed = max(failed, here.end())
                else:
                    new = getattr(self, kind)(here)
                    found = (*here.span(), new) if new is not None else self._shorter(kind, text, here, to) if kind in ("iban", "abroad", "national") else None
                if found:
                    if found[0] > start:
                        yield from self._find(text, at, found[0])
                    yield kind, *found
                    at = found[1]
                    break

    def replace(self, text: str) -> tuple[str, list[dict]]:
        """``text`` with pseudonyms, and what was replaced: kind, pseudonym, start and end in the new text."""
        out, found, at, shift = [], [], 0, 0
        for kind, begin, end, new in self._find(text, 0, len(text)):
            out += [text[at:begin], new]
            at, start = end, begin + shift
            shift += len(new) - (end - begin)
            found.append({"kind": kind, "pseudonym": new, "start": start, "end": start + len(new)})
        return "".join([*out, text[at:]]) if found else text, found


FOUND = "array<struct<kind:string,pseudonym:string,start:int,end:int>>"
FOUND_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("pseudonym", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@functools.lru_cache(4)
def _cached(key: bytes) -> Pseudonyms:
    return Pseudonyms(key)


def _replace_all(texts: pa.Array, key: bytes) -> tuple[list[str | None], list[list[dict]]]:
    names = _cached(key)
    touched = pc.fill_null(pc.match_substring_regex(texts, TRIGGER), False).to_pylist()
    new, found = texts.to_pylist(), [[]] * len(texts)
    for i, yes in enumerate(touched):
        if yes:
            new[i], found[i] = names.replace(new[i])
    return new, found


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text_col``, all other columns and rows as they are; no shuffle.

    A null or empty text stays; a text without valid private data is unchanged to the character.
    """
    place = docs.columns.index(text_col)
    schema = docs.schema

    def replace(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [f"c{k}" for k in range(batch.num_columns)]  # names may repeat
            for part in slices([batch.rename_columns(names)], names[place]):
                columns = list(part.columns)
                columns[place] = pa.array(_replace_all(part.column(place), key)[0], part.column(place).type)
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(replace, schema)


def pseudonym_report(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text with pseudonyms (null stays null), n_found and what was found with its place."""

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            new, found = _replace_all(part.column("text"), key)
            counts = pa.array([len(f) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(new, pa.string()), counts, pa.array(found, FOUND_ARROW)], ["doc_id", "text", "n_found", "found"])

    return id_and_text(docs, id_col, text_col).mapInArrow(report, f"doc_id long, text string, n_found long, found {FOUND}")


def links(report: DataFrame) -> DataFrame:
    """Per kind and pseudonym how many documents hold it: the links that the replacement keeps."""
    each = report.select("doc_id", F.explode("found").alias("f")).select("doc_id", "f.kind", "f.pseudonym")
    return each.groupBy("kind", "pseudonym").agg(F.countDistinct("doc_id").alias("n_docs"))


def recount(docs: DataFrame, text_col: str = "text", count_col: str = "n_chars") -> DataFrame:
    """``count_col``, if there is one, set to the code points of ``text_col``: pseudonyms of addresses differ in length."""
    if count_col not in docs.columns:
        return docs
    return docs.withColumn(count_col, F.length(text_col).cast(docs.schema[count_col].dataType))
