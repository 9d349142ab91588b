"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation within each value's format.

Values are found by pattern and validated (Luhn and mod-97 checks, octets,
real calendar days, impossible social-security blocks).  A value is read as
a number below the size N of its format's domain, permuted by a balanced
Feistel network on ceil(sqrt N) x ceil(sqrt N) with cycle walking, and
written in the very format it was found in; check digits are made anew.  The
pseudonym is the successor of the value on the permutation's single cycle,
so no value stays as it was.  It depends on the key and the value only:
equal values, also in different spellings, stay linked across documents,
and the key's owner can turn pseudonyms back.

Defined cases: null text stays null, empty text stays empty; of overlapping
finds the earlier, then the longer one counts; a value that fails its check
is left alone; numbers side by side are told apart by shape (cards in one
group or the usual groups before others, phones of countries with one length
before longer ones, no phone runs into another value); of a date-time the
date is replaced; repeated rows are answered alike; an empty table gives an
empty result; kept columns may have any names but the outputs'.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .worker import bounded_batches, slices

ROUNDS = 8
#: Days that dates are permuted among: 1900-01-01 to 2099-12-31.
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)


class Feistel:
    """Keyed permutations of [0, n) for any n, one for each kind of value."""

    def __init__(self, key: str | bytes):
        self.key = hashlib.blake2b(key.encode() if isinstance(key, str) else key, digest_size=32).digest()

    def _round(self, kind: str, n: int, r: int, half: int, side: int) -> int:
        width = (side.bit_length() + 7) // 8 + 8  # eight bytes more than needed, so the remainder is all but uniform
        text = f"{kind}|{n}|{r}|{half}".encode()
        raw = b"".join(hashlib.blake2b(text + bytes([i]), key=self.key, digest_size=64).digest() for i in range(-(-width // 64)))
        return int.from_bytes(raw[:width], "big") % side

    def _walk(self, kind: str, n: int, x: int, back: bool) -> int:
        side = math.isqrt(n - 1) + 1 if n > 1 else 1
        while True:
            a, b = divmod(x, side)
            for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
                a, b = ((b - self._round(kind, n, r, a, side)) % side, a) if back else (b, (a + self._round(kind, n, r, b, side)) % side)
            x = a * side + b
            if x < n:
                return x

    def permute(self, kind: str, n: int, x: int) -> int:
        return self._walk(kind, n, x, False)

    def unpermute(self, kind: str, n: int, x: int) -> int:
        return self._walk(kind, n, x, True)

    def shift(self, kind: str, n: int, x: int, by: int) -> int:
        """The value ``by`` steps on along the permutation's cycle through all of [0, n)."""
        return self.unpermute(kind, n, (self.permute(kind, n, x) + by) % n) if n > 1 else x


def luhn_digit(payload: str) -> str:
    total = sum(sum(divmod(int(c) * 2, 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(payload)))
    return str(-total % 10)


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in pattern)


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _classes(s: str) -> list[str]:
    """The alphabet that each character may be replaced from; characters outside all alphabets stay."""
    sets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    return [next((a for a in sets if c in a), c) for c in s]


def _within(f: Feistel, kind: str, s: str, by: int, sets: list[str] | None = None) -> str:
    """A string of the same character classes."""
    sets = sets or _classes(s)
    n, x = 1, 0
    for c, a in zip(s, sets):
        n, x = n * len(a), x * len(a) + a.index(c)
    # the domain is told by its classes, so that strings of other shapes have permutations of their own
    y = f.shift(f"{kind}:{''.join(a[0] if len(a) > 1 else '.' for a in sets)}", n, x, by)
    out = []
    for a in reversed(sets):
        y, k = divmod(y, len(a))
        out.append(a[k])
    return "".join(reversed(out))


def card(f: Feistel, s: str, by: int) -> str | None:
    d = _digits(s)
    if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    p = d
    while p == d or len(set(p)) == 1:  # a value of one digit only would not be found again: walk on
        n = 10 ** (len(d) - 1)
        p = str(f.shift(f"card{len(d)}", n, int(p[:-1]), by)).zfill(len(d) - 1)
        p += luhn_digit(p)
    return _refill(s, p)


def phone(f: Feistel, s: str, by: int) -> str | None:
    d = _digits(s)
    if not 8 <= len(d) + (not s.startswith("+")) <= 15:
        return None
    code = len(re.match(r"\+(\d*)", s)[1]) if s.startswith("+") else 0
    code = min(code, 3, len(d) - 7) if code else 0
    local = d[code:]
    return _refill(s, d[:code] + str(f.shift(f"phone{len(local)}", 10 ** len(local), int(local), by)).zfill(len(local)))


def ipv4(f: Feistel, s: str, by: int) -> str | None:
    parts = s.split(".")
    if any(int(p) > 255 or p != str(int(p)) for p in parts):
        return None
    x = f.shift("ipv4", 2 ** 32, int.from_bytes(bytes(map(int, parts)), "big"), by)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _real_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def ssn(f: Feistel, s: str, by: int) -> str | None:
    d = _digits(s)
    if not _real_ssn(d):
        return None
    while True:
        d = str(f.shift("ssn", 10 ** 9, int(d), by)).zfill(9)
        if _real_ssn(d):
            return _refill(s, d)


def _day(f: Feistel, day: dt.date, by: int) -> dt.date | None:
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    n = (LAST_DAY - FIRST_DAY).days + 1
    return FIRST_DAY + dt.timedelta(f.shift("date", n, (day - FIRST_DAY).days, by))


def iso_date(f: Feistel, s: str, by: int) -> str | None:
    try:
        day = _day(f, dt.date.fromisoformat(s), by)
    except ValueError:
        return None
    return day.isoformat() if day else None


def dotted_date(f: Feistel, s: str, by: int) -> str | None:
    """Day, month, year; read as month, day, year where only that is a real day, and then written so."""
    a, mark, b, year = re.fullmatch(r"(\d\d?)([./-])(\d\d?)[./-](\d{4})", s).groups()
    order = "dm" if int(b) <= 12 else "md"
    try:
        day = _day(f, dt.date(int(year), int(b if order == "dm" else a), int(a if order == "dm" else b)), by)
        while day and order == "md" and day.day <= 12:  # would be read as day and month: walk on
            day = _day(f, day, by)
    except ValueError:
        return None
    if not day:
        return None
    first, second = (day.day, day.month) if order == "dm" else (day.month, day.day)
    return f"{first:02d}{mark}{second:02d}{mark}{day.year}"


def _iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


def iban(f: Feistel, s: str, by: int) -> str | None:
    flat = s.replace(" ", "")
    if not 15 <= len(flat) <= 34 or _iban_check(flat[:2], flat[4:]) != flat[2:4]:
        return None
    rest = _within(f, f"iban{flat[:2]}", flat[4:], by)
    it = iter(flat[:2] + _iban_check(flat[:2], rest) + rest)
    return "".join(c if c == " " else next(it) for c in s)


def email(f: Feistel, s: str, by: int) -> str | None:
    local, _, domain = s.rpartition("@")
    low = local.lower()
    new = _within(f, f"email@{domain.lower()}", low, by)
    return "".join(n.upper() if c.isupper() else n for c, n in zip(local, new)) + "@" + domain


def secret(f: Feistel, s: str, by: int) -> str | None:
    hexadecimal = re.fullmatch(r"[0-9a-f]+", s)
    return _within(f, "secret", s, by, ["0123456789abcdef"] * len(s) if hexadecimal else None)


def _compile(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.ASCII)


#: Patterns of numbers, tried in a run of digits and signs; the context before and after decides too.
NUMBERS: list[tuple[str, re.Pattern, Callable]] = [
    ("date", _compile(r"(?<![\w./-])\d{4}-\d{2}-\d{2}(?:(?![\w-])|(?=[Tt]\d\d))"), iso_date),
    ("date", _compile(r"(?<![\w./-])\d{1,2}([./-])\d{1,2}\1\d{4}(?!\w)(?![./-]\d)"), dotted_date),
    ("ipv4", _compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w)(?!\.\d)"), ipv4),
    ("ssn", _compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"), ssn),
    ("phone", _compile(r"(?<![\w+(])\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\w)"), phone),
    ("phone", _compile(r"(?<![\w+(.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"), phone),
]
GROUP = _compile(r"\d+")
CARD = _compile(r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])")
#: Digit groups that cards are usually written in, besides one group.
CARD_GROUPS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}
#: First digits and lengths of issued cards; in other groups next to other numbers only these are taken.
ISSUED = [(r"4", (13, 16, 19)), (r"5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720", (16,)), (r"3[47]", (15,)), (r"30[0-5]|3[689]", (14, 16, 19)),
          (r"35(?:2[89]|[3-8])", (16, 17, 18, 19)), (r"5[06-9]|6", (13, 14, 15, 16, 17, 18, 19))]
ISSUED = [(_compile(p), n) for p, n in ISSUED]
#: A phone with its country code, as far as digit groups go; where it ends is chosen among the groups' ends.
PHONE = _compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?(\d++(?:[ .-]\d++)*+)")
#: Digits of all phones, code included, of countries where they have one length.
PHONE_DIGITS = {"1": 11, "7": 11, "33": 11, "34": 11, "41": 11, "45": 10, "47": 10, "48": 11, "91": 12}
RUN = _compile(r"[(+]*\d[\d ()+./-]{5,}")
EMAIL = _compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]*[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
IBAN = _compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)")
IBAN_LENGTHS = {c: n for n, cs in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in cs.split()}
SECRET = _compile(r"(?i:\b(?:token|secret|api[_-]?key|access[_-]?key|password|passwd)\b\s*[:=]\s*[\"']?)([A-Za-z0-9_\-]{16,})")


def _cards(text: str, start: int, end: int, taken: list[tuple[int, int]], usual: bool) -> Iterator[tuple[int, int]]:
    """Places of valid cards between digit-group bounds, from the left, clear of ``taken``: of the usual shapes, or of the others."""
    groups = [g.span() for g in GROUP.finditer(text, start, end)]
    last = start
    for i, (a, _) in enumerate(groups):
        if a < last or a and (text[a - 1] == "-" or text[a - 1] == "_" or text[a - 1].isascii() and text[a - 1].isalnum()):
            continue
        ends, digits, sizes = [], "", ()
        for k in range(i, len(groups)):
            low, high = groups[k]
            if k > i and (low - groups[k - 1][1] != 1 or text[low - 1] not in " -") or len(digits) + high - low > 19:
                break
            digits, sizes = digits + text[low:high], (*sizes, high - low)
            if len(digits) < 13 or high < len(text) and (text[high] in "-_" or text[high].isascii() and text[high].isalnum()):
                continue
            marks = {text[g[1]] for g in groups[i:k]}
            if usual and (k == i or sizes in CARD_GROUPS and len(marks) == 1):
                ends.append((high, digits))
            elif not usual and any(len(digits) in n and p.match(digits) for p, n in ISSUED):
                ends.insert(0, (high, digits))  # the longest first
        for high, digits in ends:
            if luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1 and not any(a < z and b < high for b, z in taken):
                yield a, high
                last = high
                break


def _phone_end(text: str, m: re.Match, starts: list[int]) -> int | None:
    """Where the phone ends: before the first of the ``starts`` of other values that leaves it long enough."""
    ends = {}
    for g in GROUP.finditer(text, m.start(1), m.end(1)):
        n = len(_digits(text[m.start():g.end()]))
        follows = text[g.end():g.end() + 1]
        if 8 <= n <= 15 and len(g[0]) > 1 and not (follows == "_" or follows.isascii() and follows.isalnum()):
            ends[n] = g.end()
    digits = _digits(m[0])
    size = next((n for code, n in PHONE_DIGITS.items() if digits.startswith(code)), None)
    for limit in [*sorted(s for s in starts if m.start() < s < m.end()), m.end()]:
        fit = [n for n, end in ends.items() if end <= limit]
        if fit:
            return ends[size if size in fit else max(fit)]
    return None


def _numbers(f: Feistel, text: str, start: int, end: int, by: int) -> list[tuple[int, int, str, str]]:
    """(start, -end, kind, replacement) of the validated numbers in a run of digits and signs."""
    found, stop = [], min(len(text), end + 3)

    def offer(kind, start, end, make):
        new = make(f, text[start:end], by)
        if new is not None:
            found.append((start, -end, kind, new))

    for kind, pattern, make in NUMBERS:
        for m in pattern.finditer(text, start, stop):
            offer(kind, *m.span(), make)
    for a, z in _cards(text, start, end, [], True):
        offer("card", a, z, card)
    strong = [n[0] for n in found]
    for m in PHONE.finditer(text, start, stop):
        z = _phone_end(text, m, strong)
        if z is not None:
            offer("phone", m.start(), z, phone)
    for a, z in _cards(text, start, end, [(n[0], -n[1]) for n in found], False):
        offer("card", a, z, card)
    taken = [(n[0], -n[1]) for n in found]
    for m in CARD.finditer(text, start, stop):
        if not any(m.start() < z and a < m.end() for a, z in taken):
            offer("card", *m.span(), card)
    return found


def _beginnings(s: str) -> Iterator[str]:
    """The blanks may join words that follow an IBAN: the beginning of its country's length, then all from the longest."""
    size = IBAN_LENGTHS.get(s[:2], len(s) + 1)
    m = re.match(rf"(?:[A-Z0-9] ?){{{size - 1}}}[A-Z0-9](?!\w)", s)
    if m:
        yield m[0]
    while len(s) >= 15:
        yield s
        s = s[:-1].rstrip()


def findings(f: Feistel, text: str, by: int = 1) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, replacement) of the validated values, without overlaps, in order."""
    found = []

    def offer(kind, start, end, make):
        new = make(f, text[start:end], by)
        if new is not None:
            found.append((start, -end, kind, new))

    for run in RUN.finditer(text):
        found += _numbers(f, text, *run.span(), by)
    at = text.find("@")
    while at >= 0:
        low = at
        while low and (text[low - 1].isascii() and (text[low - 1].isalnum() or text[low - 1] in "._%+-")):
            low -= 1
        m = EMAIL.match(text, low)
        if m:
            offer("email", m.start(), m.end(), email)
        at = text.find("@", at + 1)
    m = IBAN.search(text)
    while m:
        at = m.start() + 1
        for s in _beginnings(m[0]):
            if iban(f, s, by):
                offer("iban", m.start(), m.start() + len(s), iban)
                at = m.start() + len(s)
                break
        m = IBAN.search(text, at)  # others may begin inside what was refused or cut off
    if "=" in text or ":" in text:
        for m in SECRET.finditer(text):
            offer("secret", m.start(1), m.end(1), secret)
    found.sort()
    out, last = [], -1
    for start, end, kind, new in found:
        if start >= last:
            out.append((start, -end, kind, new))
            last = -end
    return out


def replace(f: Feistel, text: str, by: int = 1) -> tuple[str, list[tuple[int, int, str, str]]]:
    """The text with its values replaced, and what was found."""
    found = findings(f, text, by)
    parts, at = [], 0
    for start, end, _, new in found:
        parts += [text[at:start], new]
        at = end
    return "".join([*parts, text[at:]]), found


FOUND = "array<struct<kind:string,start:long,end:long>>"
ARROW_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def pseudonymise(docs: DataFrame, key: str | bytes, keep: list[str] | None = None, text: str = "text", out: str | None = None,
                 found: str | None = "found", back: bool = False) -> DataFrame:
    """``keep`` columns (default doc_id), the new text (named ``out``, by default as ``text``) and what was found where.

    Places are characters of the given text.  ``back`` turns pseudonyms back
    into the values.  ``found=None`` leaves that column out.
    """
    bounded_batches(docs.sparkSession)
    keep, out = keep if keep is not None else ["doc_id"], out or text
    names = [*keep, out, *([found] if found else [])]
    if len(set(names)) < len(names):
        raise ValueError("the outputs' names are among the kept columns")
    source = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        for part in slices(batches, "__text"):
            got = [(None, []) if t is None else replace(f, t, -1 if back else 1) for t in part.column(part.num_columns - 1).to_pylist()]
            cols = [*part.columns[:-1], pa.array([g[0] for g in got], pa.string())]
            if found:
                cols.append(pa.array([[{"kind": k, "start": a, "end": b} for a, b, k, _ in g[1]] for g in got], ARROW_FOUND))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = [f"`{c.name}` {c.dataType.simpleString()}" for c in source.schema.fields[:-1]] + [f"`{out}` string"]
    return source.mapInArrow(run, ", ".join(schema + ([f"`{found}` {FOUND}"] if found else [])))
