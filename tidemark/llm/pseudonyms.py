"""Format-preserving pseudonyms for personal data by a keyed Feistel network.

Found values are validated (Luhn for cards, mod 97 for IBANs, ranges for SSNs and dates, the format alone for phones and
addresses) and mapped by a keyed permutation of all values of the same format: a card becomes another valid card of the
same length and first digit, a date another date of 1900-2099 in the same notation. North American numbers and addresses
outside the assigned ranges (area code 017, first octet 127 or 248) are permuted among themselves. Equal values get equal
pseudonyms in every document (the written separators are kept, the value alone is permuted), different values get different ones. Emails and
secrets (access keys, quoted or assigned tokens and passwords) are permuted character class by character class.

The network has ``ROUNDS`` rounds with a keyed BLAKE2b as round function on a pair of numbers whose product of ranges
just covers the domain; values outside the domain or not valid are walked on until they fall inside.

Defined results: a null text stays null; an empty text stays empty; every row is handled alone, so repeated rows get
equal texts; ids are passed through, null or not; extra columns are kept only when named in ``keep``; an empty table
gives no rows. Long texts are searched whole; texts without a digit or an @ are returned as they are.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow

ROUNDS = 8
FIRST, LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

FOUND = re.compile(
    r"""(?P<email>(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![\w-]))"""
    r"""|(?P<access>(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w))"""
    r"""|(?P<secret>(?i:(?<![^\W_])(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)["']?\s{0,2}[=:]\s{0,2}["']?)"""
    r"""(?=[A-Za-z+/_\-]*+\d)[A-Za-z0-9+/_\-]{8,})"""
    r"""|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w))"""
    r"""|(?P<phone>(?<![\w+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\w)"""
    r"""|(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:(?! \d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))[ .-]?\d{2,4}){2,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}[-. ]\d{4}(?!\w)"""
    r"""|(?<![\w.-])\d{3}(?P<sep>[-. ])\d{3}(?P=sep)\d{4}(?![\w-]))"""
    r"""|(?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))"""
    r"""|(?P<date>(?<![\w.-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\w-]))"""
    r"""|(?P<ssn>(?<![\w-])\d{3}-\d\d-\d{4}(?![\w-]))"""
    r"""|(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w))""")
HINT = re.compile("[0-9@]")


class Feistel:
    """Keyed permutations of ranges [0, size)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, x: int, size: int, tweak: str, valid: Callable[[int], bool] | None = None) -> int:
        """The image of x in [0, size); walks on while it is not ``valid`` (x itself is)."""
        if size < 2:
            return x
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        while True:
            left, right = divmod(x, b)  # in [0, a) x [0, b)
            for r in range(ROUNDS):
                h = hashlib.blake2b(b"%d|%d|%d|%s" % (r, size, right if r % 2 == 0 else left, tweak.encode()),
                                    key=self.key, digest_size=48).digest()
                f = int.from_bytes(h, "little")
                if r % 2 == 0:
                    left = (left + f) % a
                else:
                    right = (right + f) % b
            x = left * b + right
            if x < size and (valid is None or valid(x)):
                return x


def alike(x: int, size: int, tweak: str, usual: Callable[[int], bool], f: Feistel) -> int:
    """The image of x in [0, size): ``usual`` values are permuted among themselves, and so are the others."""
    ok = usual(x)
    return f.permute(x, size, tweak, lambda y: usual(y) == ok)


def luhn(digits: str) -> bool:
    return check_digit(digits[:-1]) == digits[-1]


def check_digit(body: str) -> str:
    total = 0
    for i, ch in enumerate(reversed(body)):
        d = int(ch) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def mod97(iban: str) -> int:
    return int("".join(str(int(ch, 36)) for ch in iban[4:] + iban[:4])) % 97


def refill(shape: str, values: str) -> str:
    """``shape`` with its letters and digits replaced, in order, by ``values``."""
    it = iter(values)
    return "".join(next(it) if ch.isalnum() else ch for ch in shape)


def classes(text: str, f: Feistel, tweak: str, hexa: bool = False) -> str:
    """Letters and digits permuted together, each position within its class (hexadecimal digits as one class)."""
    kinds = ["0123456789abcdef"] if hexa else ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    at = [next((k for k in kinds if ch in k), None) for ch in text]
    x, size = 0, 1
    for ch, k in zip(text, at):
        if k:
            x, size = x * len(k) + k.index(ch), size * len(k)
    x = f.permute(x, size, tweak)
    out = []
    for ch, k in zip(reversed(text), reversed(at)):
        if k:
            x, i = divmod(x, len(k))
            ch = k[i]
        out.append(ch)
    return "".join(reversed(out))


def _card(v: str, f: Feistel) -> str | None:
    d = re.sub(r"\D", "", v)
    if not 13 <= len(d) <= 19 or not luhn(d) or len(set(d)) == 1:
        return None
    n = len(d) - 2
    body = d[0] + str(f.permute(int(d[1:-1]), 10**n, f"card{len(d)}{d[0]}", lambda x: len(set(d[0] + str(x).zfill(n))) > 1)).zfill(n)
    return refill(v, body + check_digit(body))


def _iban(v: str, f: Feistel) -> str | None:
    s = v.replace(" ", "")
    if not 15 <= len(s) <= 34 or mod97(s) != 1:
        return None
    body = classes(s[4:], f, "iban" + s[:2])
    return refill(v, s[:2] + str(98 - mod97(s[:2] + "00" + body)).zfill(2) + body)


def _ssn_ok(x: int) -> bool:
    area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(v: str, f: Feistel) -> str | None:
    x = int(v.replace("-", ""))
    return refill(v, str(f.permute(x, 10**9, "ssn", _ssn_ok)).zfill(9)) if _ssn_ok(x) else None


def _nanp_ok(x: int) -> bool:
    return x // 10**9 >= 2 and x // 10**6 % 10 >= 2


def _phone(v: str, f: Feistel) -> str | None:
    d = re.sub(r"\D", "", v)
    if v[0] == "+":
        if not 8 <= len(d) <= 15:
            return None
        cc = "1" if d[0] == "1" else re.match(r"\+(\d{1,3})", v)[1] if re.match(r"\+\d{1,3}[ .(-]", v) else d[:2]
    else:
        cc = ""
    own = d[len(cc):]
    if cc in ("", "1") and len(own) == 10:
        return refill(v, cc + str(alike(int(own), 10**10, "phone1", _nanp_ok, f)).zfill(10))
    return refill(v, cc + str(f.permute(int(own), 10 ** len(own), f"phone{cc}")).zfill(len(own)))


def _ip_ok(x: int) -> bool:
    return 0 < x >> 24 < 224 and x >> 24 != 127


def _ip(v: str, f: Feistel) -> str | None:
    o = [int(x) for x in v.split(".")]
    x = sum(b << 8 * (3 - i) for i, b in enumerate(o))
    if max(o) > 255:
        return None
    x = alike(x, 2**32, "ip", _ip_ok, f)
    return ".".join(str(x >> 8 * (3 - i) & 255) for i in range(4))


def _date(v: str, f: Feistel) -> str | None:
    p = re.split(r"[-/.]", v)
    swap = False
    if len(p[0]) == 4:
        y, m, d = map(int, p)
    elif "." in v:
        d, m, y = map(int, p)
    else:
        m, d, y = map(int, p)
        swap = m > 12  # day first where the first number can't be a month
        m, d = (d, m) if swap else (m, d)
    try:
        x = datetime.date(y, m, d).toordinal()
    except ValueError:
        return None
    if not FIRST <= x <= LAST:
        return None
    n = datetime.date.fromordinal(FIRST + f.permute(x - FIRST, LAST - FIRST + 1, "date"))
    if len(p[0]) == 4:
        return f"{n.year:04}{v[4]}{n.month:02}{v[4]}{n.day:02}"
    if "." in v:
        return f"{n.day:02}.{n.month:02}.{n.year:04}"
    return f"{n.day:02}/{n.month:02}/{n.year:04}" if swap and n.day > 12 else f"{n.month:02}/{n.day:02}/{n.year:04}"


def _email(v: str, f: Feistel) -> str:
    head, tld = v.rsplit(".", 1)
    return classes(head, f, "email") + "." + tld


def _access(v: str, f: Feistel) -> str:
    return v[:4] + classes(v[4:], f, "access")


def _secret(v: str, f: Feistel) -> str:
    m = re.search(r"[A-Za-z0-9+/_\-]+\Z", v)
    s = m[0]
    if "=" not in v[:m.start()] and ":" not in v[:m.start()]:
        return v
    return v[:m.start()] + classes(s, f, "secret", hexa=re.fullmatch("[0-9a-f]+", s) is not None)


KINDS: dict[str, Callable[[str, Feistel], str | None]] = {
    "email": _email, "access": _access, "secret": _secret, "iban": _iban, "phone": _phone, "ip": _ip, "date": _date,
    "ssn": _ssn, "card": _card}


def replace(text: str, f: Feistel) -> tuple[str, list[str]]:
    """(text with pseudonyms, kinds of the values replaced, in order)."""
    if not HINT.search(text):
        return text, []
    kinds: list[str] = []
    out: list[str] = []
    at = pos = 0
    while m := FOUND.search(text, pos):
        kind, v = m.lastgroup, m[0]
        new = KINDS[kind](v, f)
        while new is None and kind == "phone" and v[0] == "+" and (short := re.match(r"(.+)[ .-]\d+\Z", v)):
            v = short[1]  # digits of a next value, such as an address, after the number
            new = _phone(v, f)
        if new is None:
            v = m[0]
        if new is None and kind in ("phone", "iban"):  # a failed longer form may still be a card number
            kind, new = "card", _card(v, f) if re.fullmatch(r"\d(?:[ -]?\d){12,18}", v) else None
        pos = m.start() + len(v)
        if new is not None:
            kinds.append(kind)
            out += [text[at:m.start()], new]
            at = pos
    return "".join([*out, text[at:]]), kinds


def pseudonymize(docs: DataFrame, key: str, keep: list[str] | None = None, text: str = "text",
                 found: str | None = "kinds") -> DataFrame:
    """``keep`` (default ``doc_id``) and ``text`` with pseudonyms; ``found`` names an array of the kinds replaced."""
    keep = ["doc_id"] if keep is None else [c for c in keep if c != text]
    rows = docs.select(*[F.col(c) for c in keep], F.col(text))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(text, T.StringType())]
                          + ([T.StructField(found, T.ArrayType(T.StringType()))] if found else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Feistel(key.encode())
        for b in batches:
            new, kinds = [], []
            for t in b.column(len(keep)).to_pylist():
                x, k = (t, []) if t is None else replace(t, f)
                new.append(x)
                kinds.append(k)
            cols = [b.column(i) for i in range(len(keep))] + [pa.array(new, pa.string())]
            names = [*keep, text]
            if found:
                cols.append(pa.array(kinds, pa.list_(pa.string())))
                names.append(found)
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return map_arrow(rows, run, schema)


def op5(docs: DataFrame, key: str) -> DataFrame:
    out = pseudonymize(docs, key)
    return out.select("doc_id", "text", F.size("kinds").cast("long").alias("n_found"), F.array_join("kinds", ",").alias("kinds"))
