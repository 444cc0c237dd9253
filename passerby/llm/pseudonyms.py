"""Personal data replaced by pseudonyms of the same format.

Found are card numbers, phone numbers, IP addresses, bank accounts, social
security numbers, dates, mail addresses and secret tokens, each only if it is
valid for its kind. A value's digits (or letters) are one number of a fixed
range; a keyed Feistel network permutes that range. So a pseudonym has the
format of what it stands for, passes the same check, and is the same wherever
the value occurs, while two values never share one. Whoever has the key can go
back.
"""

import datetime
import functools
import hashlib
import hmac
import re
import secrets
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.llm.rows import make_room

ROUNDS = 10
#: Where a session may name the key; without one every run has a random key of its own.
KEY_SETTING = "spark.passerby.pseudonyms.key"


def _mix(key: bytes, kind: str, turn: int, value: int, size: int) -> int:
    message = f"{kind}:{turn}:{size}:{value}".encode()
    return int.from_bytes(hmac.digest(key, message, "sha256")[:16], "big") % size


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed permutation of 0 .. ``size`` - 1.

    Left and right part of a value lie in ranges of about the root of ``size``.
    Their product may be a little larger than ``size``; values that land above
    are permuted on until they land below, which keeps the whole a permutation.
    """
    if size < 2:
        return value
    left = 1
    while left * left < size:
        left *= 2
    right = -(-size // left)
    while True:
        a, b = value // right, value % right
        for turn in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2:
                b = (b + sign * _mix(key, kind, turn, a, right)) % right
            else:
                a = (a + sign * _mix(key, kind, turn, b, left)) % left
        value = a * right + b
        if value < size:
            return value


def luhn(digits: str) -> bool:
    """Whether a card number's last digit fits the others."""
    twice = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def _card_valid(digits: str) -> bool:
    """A known issuer's first digits and length, and a fitting last digit. The issuers' ranges."""
    n, two, three, four = len(digits), int(digits[:2]), int(digits[:3]), int(digits[:4])
    known = (
        (digits[0] == "4" and n in (13, 16, 19))
        or ((51 <= two <= 55 or 2221 <= four <= 2720) and n == 16)
        or (two in (34, 37) and n == 15)
        or ((four == 6011 or 644 <= three <= 649 or two == 65) and n in (16, 19))
        or ((300 <= three <= 305 or two in (36, 38)) and n == 14)
        or (3528 <= four <= 3589 and n == 16))
    return known and luhn(digits)


def _fill(template: str, characters: str, test: Callable[[str], bool]) -> str:
    """``template`` with its characters of a kind replaced in order."""
    source = iter(characters)
    return "".join(next(source) if test(c) else c for c in template)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _is_digit(c: str) -> bool:
    return c in "0123456789"


def _card(found: str, key: bytes, back: bool) -> str | None:
    """The first six digits and the length stay, the last digit fits again."""
    digits = _digits(found)
    if not 13 <= len(digits) <= 19 or not _card_valid(digits):
        return None
    head, body = digits[:6], digits[6:-1]
    new = str(permute(int(body), 10 ** len(body), key, f"card:{head}", back)).zfill(len(body))
    return _fill(found, next(head + new + d for d in "0123456789" if luhn(head + new + d)), _is_digit)


#: The country codes of two digits. 1 and 7 stand alone, all others have three.
CODES = {20, 27, 30, 31, 32, 33, 34, 36, 39, 40, 41, 43, 44, 45, 46, 47, 48, 49, 51, 52, 53, 54, 55, 56, 57, 58, 60, 61, 62, 63, 64, 65, 66,
         81, 82, 84, 86, 90, 91, 92, 93, 94, 95, 98}


def _code_digits(digits: str) -> int:
    return 1 if digits[0] in "17" else 2 if int(digits[:2]) in CODES else 3


def _phone(found: str, key: bytes, back: bool) -> str | None:
    """The country code and the grouping stay. Ten digits without a code are those of +1, and linked with them."""
    digits = _digits(found)
    if not 8 <= len(digits) <= 15:
        return None
    coded = found.startswith("+") or (len(digits) == 11 and digits[0] == "1")
    keep = _code_digits(digits) if coded else 0
    head, body = digits[:keep], digits[keep:]
    new = str(permute(int(body), 10 ** len(body), key, f"phone:{head or '1'}", back)).zfill(len(body))
    return _fill(found, head + new, _is_digit)


def _address(found: str, key: bytes, back: bool) -> str | None:
    parts = found.split(".")
    if any(int(part) > 255 or (len(part) > 1 and part[0] == "0") for part in parts):
        return None
    new = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "address", back)
    return ".".join(map(str, new.to_bytes(4, "big")))


def _account_fits(account: str) -> bool:
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _account(found: str, key: bytes, back: bool) -> str | None:
    """The country, the bank's letters and the length stay, the check digits fit again."""
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or not _account_fits(plain):
        return None
    country, body = plain[:2], plain[4:]
    digits = _digits(body)
    if not digits:
        return None
    new = str(permute(int(digits), 10 ** len(digits), key, f"account:{country}:{len(digits)}", back)).zfill(len(digits))
    body = _fill(body, new, _is_digit)
    check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    return _fill(found, f"{country}{check:02d}{body}", lambda c: c != " ")


#: Social security numbers: area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999.
AREAS = 898


def _security(found: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, found.split("-"))
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(permute(number, AREAS * 99 * 9999, key, "security", back), 9999)
    area, group = divmod(rest, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


#: Days that dates are permuted among.
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def _day(year: str, month: str, day: str) -> int | None:
    """The number of a day that dates are permuted among; None if it is none."""
    try:
        number = datetime.date(int(year), int(month), int(day)).toordinal()
    except ValueError:
        return None
    return number if FIRST_DAY <= number <= LAST_DAY else None


def _date(found: str, key: bytes, back: bool) -> str | None:
    """Year first, day first, or month first where day first is no date, with the sign between them.

    Dates with the month first are permuted among those that cannot be read day
    first, days after the 12th, so that the pseudonym is read as they are.
    """
    one, sign, two, other, three = re.split(r"([-/.])", found)
    if sign != other:
        return None
    number, month_first = _day(one, two, three) if len(one) == 4 else _day(three, two, one), False
    if number is None and len(one) != 4:
        number, month_first = _day(three, one, two), True
    if number is None:
        return None
    while True:
        number = FIRST_DAY + permute(number - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, "date:month" if month_first else "date", back)
        new = datetime.date.fromordinal(number)
        if not month_first or new.day > 12:
            break
    year, month, day = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
    return sign.join((year, month, day) if len(one) == 4 else (month, day, year) if month_first else (day, month, year))


def _letters(text: str, key: bytes, kind: str, back: bool) -> str:
    """ASCII letters and digits of a text permuted together, each within its own kind: small, large, digit."""
    small, large, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    value, size, kinds = 0, 1, []
    for c in text:
        own = small if c in small else large if c in large else digits if c in digits else None
        kinds.append(own)
        if own:
            value, size = value * len(own) + own.index(c), size * len(own)
    shape = "".join("a" if k is small else "A" if k is large else "0" if k else c for k, c in zip(kinds, text, strict=True))
    value = permute(value, size, key, f"{kind}:{hashlib.sha256(shape.encode()).hexdigest()[:16]}", back)
    out = []
    for own, c in zip(reversed(kinds), reversed(text), strict=True):
        if own:
            value, at = divmod(value, len(own))
            c = own[at]
        out.append(c)
    return "".join(reversed(out))


def _mail(found: str, key: bytes, back: bool) -> str | None:
    """The part before the sign is permuted, the domain stays: letters beyond ASCII stay too."""
    name, _, domain = found.rpartition("@")
    return f"{_letters(name, key, f'mail:{domain.lower()}', back)}@{domain}"


def _secret(found: str, key: bytes, back: bool) -> str | None:
    """Hexadecimal digits stay hexadecimal, in their case; other tokens keep small letters, large ones and digits apart."""
    for digits in ("0123456789abcdef", "0123456789ABCDEF"):
        if all(c in digits for c in found):
            new = permute(int(found, 16), 16 ** len(found), key, f"secret:{len(found)}:{digits[10]}", back)
            spelt = f"{new:0{len(found)}x}"
            return spelt if digits[10] == "a" else spelt.upper()
    return _letters(found, key, "secret", back)


#: Kinds in the order in which they are tried at a place: name, pattern, what replaces the first group.
KINDS: tuple[tuple[str, str, Callable[[str, bytes, bool], str | None]], ...] = (
    ("mail", r"(?<![\w.+%-])(\w[\w.+%-]*@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,})(?![A-Za-z0-9-])", _mail),
    ("secret", r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|key)\b[\"']?[ \t]*[:=][ \t]*[\"']?)([A-Za-z0-9+/_-]{16,})(?![A-Za-z0-9+/_-])", _secret),
    ("secret", r"(?<![A-Za-z0-9])((?:[0-9]+[a-f]|[a-f]+[0-9])[0-9a-f]{30,}|(?:[0-9]+[A-F]|[A-F]+[0-9])[0-9A-F]{30,})(?![A-Za-z0-9])", _secret),
    ("secret", r"(?<![A-Za-z0-9])(?:ghp_|gho_|ghs_|github_pat_|sk-|xox[abp]-|AKIA|glpat-)([A-Za-z0-9_-]{16,})(?![A-Za-z0-9_-])", _secret),
    ("account", r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", _account),
    ("date", r"(?<![\w.-/])([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}[-/.][0-9]{2}[-/.][0-9]{4})(?![\w/-](?<!T)|T(?![0-9]{2}:))", _date),
    ("security", r"(?<![\w-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])", _security),
    ("address", r"(?<![\w.])([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![\w]|\.[0-9])", _address),
    ("phone", r"(?<![\w+])(\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
              r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{1,4}){0,3}[ .-]?[0-9]{2,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}"
              r"|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![\w-])", _phone),
    ("card", r"(?<![\w.-])([0-9](?:[ -]?[0-9]){12,18})(?![\w-])", _card),
)
#: A text without any of these has nothing to be found, so most texts are searched once. Every kind has to hold one: the shortest address has 7 characters.
HINT = re.compile(r"@|[0-9][0-9 .\-/()]{5,}[0-9]|(?i:token|secret|passw(?:or)?d|key)[\"']?[ \t]*[:=]|[0-9A-Fa-f]{32}|[A-Z]{2}[0-9]{2}|gh[pos]_|github_pat_|sk-|xox[abp]-|AKIA|glpat-")


@functools.cache
def _patterns() -> tuple[tuple[str, re.Pattern, Callable], ...]:
    return tuple((name, re.compile(pattern), replace) for name, pattern, replace in KINDS)


def _shorter(pattern: re.Pattern, text: str, start: int, end: int) -> re.Match | None:
    """The next shorter match from ``start`` on that ends before a space or dot: a number that follows was read into it."""
    ends = (at for at in range(end - 1, start, -1) if text[at] in " .")
    return next(filter(None, (pattern.fullmatch(text, start, at) for at in ends)), None)


def replace(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of each in the new text, in order.

    Kinds are tried in their order, each in the gaps between what earlier ones
    have taken.
    """
    if not HINT.search(text):
        return text, []
    taken: list[tuple[int, int, str, str]] = []
    for name, pattern, new in _patterns():
        found = []
        # What was taken begins behind a sign, so a gap's end parts no word; what lies before a gap is still looked back at.
        for low, high in zip([0, *(end for _, end, _, _ in taken)], [*(start for start, _, _, _ in taken), len(text)], strict=True):
            for match in pattern.finditer(text, low, high):
                start, end = match.span(1)
                value = new(match[1], key, back)
                while value is None and name == "phone" and (shorter := _shorter(pattern, text, start, end)):
                    end = shorter.end(1)
                    value = new(shorter[1], key, back)
                if value is not None:
                    found.append((start, end, name, value))
        taken = sorted(taken + found)
    out, spans, at, size = [], [], 0, 0
    for start, end, name, value in taken:
        size += start - at
        out += [text[at:start], value]
        spans.append((name, size, size + len(value)))
        size, at = size + len(value), end
    return "".join([*out, text[at:]]), spans


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def key_of(spark: SparkSession, key: str | None = None) -> str:
    """The key given, else that of the session's `KEY_SETTING`, else a random one, which nobody can go back by."""
    return key or spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)


def pseudonymise(docs: DataFrame, key: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with the text replaced and ``pii``, the places of the pseudonyms in it, replacing a column of this name.

    A null text stays null and has no places. A text without personal data stays
    as it is, character for character. Equal values get equal pseudonyms in all
    documents, under one key, see `key_of`. ``back`` undoes the replacement of an
    equal key.
    Texts are read whole; repeated rows come out alike; other columns pass
    through.
    """
    kept = docs.drop("pii")
    schema = T.StructType([*kept.schema.fields, T.StructField("pii", SPANS)])
    at, secret = kept.columns.index("text"), key_of(docs.sparkSession, key).encode()

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room("pseudonyms")
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts, spans = [], []
                for text in part.column(at).to_pylist():
                    new, found = (text, []) if text is None else replace(text, secret, back)
                    texts.append(new)
                    spans.append([{"kind": kind, "start": start, "end": end} for kind, start, end in found])
                columns = list(part.columns)
                columns[at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, ARROW_SPANS)], [field.name for field in schema.fields])

    return kept.mapInArrow(change, schema)


def pseudonyms(docs: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, text with pseudonyms, their number and places."""
    return pseudonymise(docs.select("doc_id", "text"), key).select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"), "pii")
