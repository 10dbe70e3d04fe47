"""Private data in every form that the operator knows, links across forms, and values of any length."""

import itertools
import re

import pytest

from tallymart.llm.pseudonyms import Pseudonyms

NAMES = Pseudonyms(b"a key for tests")

# a text, what must not be left of it, and the form of what stands there instead
FORMS = [
    ("password=пароль123", "пароль", r"password=[^\x00-\x7f]{6}\d{3}"),
    ("password=" + "aB3" * 40, "aB3aB3", r"password=([a-z][A-Z]\d){40}"),
    ("pwd: x1", "x1", r"pwd: [a-z]\d"),
    ("a" * 80 + "@host.com", "aaa", r"[a-z]{80}@host\.com"),
    ("josé.garcia@x.com", "garcia", r"[a-z]{3}[^\x00-\x7f]\.[a-z]{6}@x\.com"),
    ("born 3/4/1987", "3/4/1987", r"born \d{1,2}/\d{1,2}/\d{4}"),
    ("born 1987-3-4", "1987-3-4", r"born \d{4}-\d{1,2}-\d{1,2}"),
    ("born 12 March 1987.", "March 1987", r"born \d{1,2} [A-Z][a-z]+ \d{4}\."),
    ("on March 12th, 1987", "1987", r"on [A-Z][a-z]+ \d{1,2}(st|nd|rd|th), \d{4}"),
    ("le 12 février 1987", "1987", r"le \d{1,2} \w+ \d{4}"),
    ("12. MÄRZ 1987", "MÄRZ 1987", r"\d{1,2}\. [A-ZÄ]+ \d{4}"),
    ("12 de marzo de 1987", "1987", r"\d{1,2} de [a-z]+ de \d{4}"),
    ("call 3895555010 now", "3895555010", r"call \d{10} now"),
    ("no 123 45 6789", "123 45", r"no \d{3} \d\d \d{4}"),
    ("from 2001:db8:0:0:0:0:0:1", "2001", r"from [0-9a-f]{1,4}:[0-9a-f]{1,4}:0:0:0:0:0:[0-9a-f]{1,4}"),
    ("from 2001:DB8::1F", "DB8", r"from [0-9A-F]{1,4}:[0-9A-F]{1,4}::[0-9A-F]{1,4}"),
    ("tel 020 7946 0958", "7946", r"tel 0[1-9]\d \d{4} \d{4}"),
    ("tel (020) 7946-0958", "7946", r"tel \(0[1-9]\d\) \d{4}-\d{4}"),
]


@pytest.mark.parametrize("text, gone, form", FORMS, ids=[f[0][:20] for f in FORMS])
def test_form(text, gone, form):
    new, found = NAMES.replace(text)
    assert re.fullmatch(form, new) and gone not in new and len(found) == 1
    assert new[found[0]["start"] : found[0]["end"]] == found[0]["pseudonym"]
    assert NAMES.replace(f"so {text} then")[0] == f"so {new} then"


@pytest.mark.parametrize("text", ["std::vector a::b 12:30:45", "0.3895555010", "v 10.2.2020.1", "31 June 1987", "5 May", "::", "x 12345678901234", "", "@ 1"])
def test_left_alone(text):
    assert NAMES.replace(text) == (text, [])


def only(text):
    return NAMES.replace(text)[1][0]["pseudonym"]


def test_links_across_forms():
    """One value has one pseudonym however it is written."""
    day = [int(x) for x in only("1987-03-12").split("-")]
    for text in ("1987/3/12", "1987.03.12"):
        assert [int(x) for x in re.split(r"[-/.]", only(text))] == day
    for text in ("12/03/1987", "12.3.1987", "12-03-1987"):
        assert [int(x) for x in re.split(r"[-/.]", only(text))] == day[::-1]
    months = "January February March April May June July August September October November December".split()
    assert only("12 March 1987").split() == [str(day[2]), months[day[1] - 1], str(day[0])]
    assert only("Mar 12, 1987").split() == [months[day[1] - 1][:3], f"{day[2]},", str(day[0])]
    assert only("389 555 5010").replace(" ", "") == only("3895555010") == only("(389) 555-5010").translate({ord(c): None for c in "() -"})
    assert only("123-45-6789").replace("-", " ") == only("123 45 6789")
    short = only("2001:db8::1").split("::")
    assert only("2001:db8:0:0:0:0:0:1") == f"{short[0]}:0:0:0:0:0:{short[1]}"


def test_different_values_stay_different():
    """Every value of a small format, and long values that differ in one place."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    assert len({only(f"pwd={a}{b}") for a, b in itertools.product(letters, letters)}) == 26 * 26
    base = "password=" + "abcdefgh" * 20
    changed = [base] + [base[:k] + "z" + base[k + 1 :] for k in range(len("password="), len(base))]
    new = [only(x) for x in changed]
    assert len(set(new)) == len(new) and all(len(x) == len(base) for x in new)
    # no part of a long value shows through
    assert all(sum(a == b for a, b in zip(x, y, strict=True)) < 40 for x, y in zip(new, changed, strict=True))


def test_values_of_any_length():
    secret = "k" * 200_000
    new = NAMES.replace(f"see password={secret} there")[0]
    assert re.fullmatch(r"see password=[a-z]{200000} there", new) and "kkkkk" not in new
