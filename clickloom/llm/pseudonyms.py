"""Format-preserving pseudonyms for personal numbers and dates, in SQL functions.

Candidates are cut out of a text with one pattern, validated, and replaced by a
keyed permutation of their own format: a card number by a card number with a
right check digit, a date by a date, an address by an address. Equal values get
equal pseudonyms wherever they occur, different ones stay different, and who
has the key can undo them.

The permutation is an alternating Feistel network. A value is a pair of numbers
below ``a`` and ``b``; in turn, a keyed hash of one is added to the other modulo
its bound. ``a * b`` is exactly the number of valid values of the format, so no
result ever has to be drawn again.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DEMO_KEY = "clickloom-demonstration-key"

EMAIL = r"(?<![\p{L}\p{N}])[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+"
IP = r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?![\p{L}\p{N}]|\.\d)"
DATE = r"(?<![\p{L}\p{N}./-])(?:\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})(?!(?!T\d\d:)[\p{L}\p{N}]|[./-]\d)"
SSN = r"(?<![\p{L}\p{N}-])\d{3}-\d\d-\d{4}(?![\p{L}\p{N}]|-\d)"
CARD = r"(?<![\p{L}\p{N}+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}]|-\d)"
PHONE = (
    r"(?<![\p{L}\p{N}+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{3,4}(?![\p{L}\p{N}]|-\d)"
    r"|(?<![\p{L}\p{N}+])\+\d{8,15}(?![\p{L}\p{N}])"
    r"|(?<![\p{L}\p{N}+])\+\d{1,3}(?:[ .-]\(?\d{2,5}\)?){0,2}[ .-]\d{3,8}(?![\p{L}\p{N}]|-\d)"
    r"|(?<![\p{L}\p{N}+(./-])(?:\(0\d{1,4}\) ?|0\d{1,4}[ /-])\d{5,8}(?![\p{L}\p{N}]|[./-]\d)"
)
CANDIDATE = "|".join((EMAIL, IP, DATE, SSN, CARD, PHONE))

FIRST_DAY = "1900-01-01"
DAY_BOUNDS = (319, 229)  # 73,051 days, up to 2100-01-02
SSN_BOUNDS = (898 * 99, 9_999)  # areas without 000, 666 and 900 on; groups; serials


@dataclass(frozen=True)
class Key:
    """A secret and a direction; the secret stands in the plan, so keep plans private."""

    secret: str = DEMO_KEY
    undo: bool = False

    def number(self, kind: str, turn: Column, value: Column) -> Column:
        """48 bits of a keyed hash."""
        text = F.concat_ws("|", F.lit(self.secret), F.lit(kind), turn.cast("string"), value.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("bigint")

    def turns(self) -> Column:
        first, last = (ROUNDS - 1, 0) if self.undo else (0, ROUNDS - 1)
        return F.sequence(F.lit(first), F.lit(last), F.lit(-1 if self.undo else 1))

    @property
    def sign(self) -> int:
        return -1 if self.undo else 1


def permuted(key: Key, kind: str, value: Column, a: Column, b: Column) -> Column:
    """Keyed permutation of ``value`` below ``a * b``."""
    first = F.struct(_div(value, b).alias("x"), F.pmod(value, b).alias("y"))

    def turn(state: Column, i: Column) -> Column:
        x, y = state["x"], state["y"]
        moved_x = F.pmod(x + F.lit(key.sign) * F.pmod(key.number(kind, i, y), a), a)
        moved_y = F.pmod(y + F.lit(key.sign) * F.pmod(key.number(kind, i, x), b), b)
        even = i % 2 == 0
        return F.struct(
            F.when(even, moved_x).otherwise(x).alias("x"), F.when(even, y).otherwise(moved_y).alias("y")
        )

    return F.aggregate(key.turns(), first, turn, lambda s: s["x"] * b + s["y"])


def _div(value: Column, by: Column) -> Column:
    return F.call_function("div", value, by)


def long(value: int | str | Column) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("bigint")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def filled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def step(state: Column, char: Column) -> Column:
        digit = char.between("0", "9")
        return F.struct(
            F.concat(
                state["out"],
                F.when(digit, F.substr(digits, state["next"], F.lit(1))).otherwise(char),
            ).alias("out"),
            F.when(digit, state["next"] + 1).otherwise(state["next"]).alias("next"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def power_of_ten(n: Column) -> Column:
    return F.concat(F.lit("1"), F.repeat(F.lit("0"), n)).cast("bigint")


def permuted_digits(key: Key, kind: str, digits: Column) -> Column:
    """Keyed permutation of a run of up to 18 digits of the same length."""
    n = F.length(digits)
    half = _div(n, F.lit(2)).cast("int")
    value = permuted(key, kind, digits.cast("bigint"), power_of_ten(n - half), power_of_ten(half))
    return F.lpad(value.cast("string"), n, F.lit("0"))


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Sum of the check-digit rule, from the right; which place doubles is given."""
    places = F.split(F.reverse(digits), "")

    def weigh(d: Column, i: Column) -> Column:
        value = d.cast("int")
        double = (i % 2 == 0) if doubled_first else (i % 2 == 1)
        return F.when(double, value * 2 - F.when(value > 4, 9).otherwise(0)).otherwise(value)

    return F.aggregate(F.transform(places, weigh), F.lit(0), lambda s, x: s + x)


def is_card(match: Column) -> Column:
    digits = digits_of(match)
    return match.rlike(f"^(?:{CARD})$") & digits.rlike("^[2-6]") & (luhn_sum(digits, False) % 10 == 0)


def card(key: Key, match: Column) -> Column:
    """The first digit stays, the last is the check digit of the permuted others."""
    digits = digits_of(match)
    body = permuted_digits(key, "card", F.substr(digits, F.lit(2), F.length(digits) - 2))
    body = F.concat(F.left(digits, F.lit(1)), body)
    check = F.pmod(-luhn_sum(body, True), F.lit(10)).cast("string")
    return filled(match, F.concat(body, check))


def is_ip(match: Column) -> Column:
    small = F.forall(F.split(match, r"\."), lambda octet: octet.cast("int") <= 255)
    return match.rlike(f"^(?:{IP})$") & small


def ip(key: Key, match: Column) -> Column:
    value = F.aggregate(F.split(match, r"\."), long(0), lambda s, o: s * 256 + o.cast("bigint"))
    moved = permuted(key, "ip", value, long(65_536), long(65_536))
    octets = [_div(moved, long(256**k)) % 256 for k in (3, 2, 1, 0)]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


# Date formats by the match's look; of two readings the first valid one counts.
FORMATS = (
    (r"^\d{4}-", "yyyy-MM-dd"),
    (r"^\d\d\.", "dd.MM.yyyy"),
    (r"^\d\d/", "MM/dd/yyyy"),
    (r"^\d\d/", "dd/MM/yyyy"),
)


def _day_number(match: Column, form: str) -> Column:
    return F.date_diff(F.try_to_date(match, form), F.to_date(F.lit(FIRST_DAY)))


def _readings(match: Column) -> list[tuple[Column, str, Column]]:
    out = []
    for look, form in FORMATS:
        day = _day_number(match, form)
        fits = match.rlike(look) & day.between(0, DAY_BOUNDS[0] * DAY_BOUNDS[1] - 1)
        out.append((F.coalesce(fits, F.lit(False)), form, day))
    return out


def is_date(match: Column) -> Column:
    fits = F.lit(False)
    for valid, _, _ in _readings(match):
        fits = fits | valid
    return match.rlike(f"^(?:{DATE})$") & fits


def date(key: Key, match: Column) -> Column:
    out = match
    for valid, form, day in reversed(_readings(match)):
        moved = permuted(key, "date", day.cast("bigint"), *map(long, DAY_BOUNDS))
        text = F.date_format(F.date_add(F.to_date(F.lit(FIRST_DAY)), moved.cast("int")), form)
        out = F.when(valid, text).otherwise(out)
    return out


def is_ssn(match: Column) -> Column:
    area, group, serial = (F.substr(match, F.lit(at), F.lit(n)).try_cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    return match.rlike(f"^(?:{SSN})$") & F.coalesce(valid, F.lit(False))


def ssn(key: Key, match: Column) -> Column:
    area, group, serial = (F.substr(match, F.lit(at), F.lit(n)).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4)))
    area = area - 1 - F.when(area > 666, 1).otherwise(0)
    value = (area * 99 + group - 1) * 9_999 + serial - 1
    moved = permuted(key, "ssn", value, *map(long, SSN_BOUNDS))
    new_serial, rest = moved % 9_999 + 1, _div(moved, long(9_999))
    new_group, new_area = rest % 99 + 1, _div(rest, long(99)) + 1
    new_area = new_area + F.when(new_area >= 666, 1).otherwise(0)
    return F.concat_ws(
        "-",
        F.lpad(new_area.cast("string"), 3, "0"),
        F.lpad(new_group.cast("string"), 2, "0"),
        F.lpad(new_serial.cast("string"), 4, "0"),
    )


def is_phone(match: Column) -> Column:
    """Eight to fifteen digits with a separator, or after a plus sign."""
    return match.rlike(f"^(?:{PHONE})$") & F.length(digits_of(match)).between(8, 15)


def phone(key: Key, match: Column) -> Column:
    """The country code stays, or the zero in front of a local number of two groups."""
    code = F.regexp_extract(match, r"^\+\d{1,3}(?=[^0-9])|^\+\d\d|^\(?0(?=\d{1,4}\)?[ /-]?\d{5,8}$)", 0)
    rest = F.substr(match, F.length(code) + 1)
    return F.concat(code, filled(rest, permuted_digits(key, "phone", digits_of(rest))))


def _shifted(key: Key, text: Column, turn: Column, other: Column) -> Column:
    """Letters and digits moved within their alphabets by a keyed hash of ``other``."""

    def move(char: Column, i: Column) -> Column:
        by = F.lit(key.sign) * F.pmod(key.number("email", turn, F.concat_ws("|", i.cast("string"), other)), F.lit(130))
        out = char
        for first, size in (("a", 26), ("A", 26), ("0", 10)):
            last = chr(ord(first) + size - 1)
            moved = F.char(F.pmod(F.ascii(char) - ord(first) + by, F.lit(size)) + ord(first))
            out = F.when(char.between(first, last), moved).otherwise(out)
        return out

    # Splitting an empty text gives one empty piece, which stays empty.
    return F.array_join(F.transform(F.split(text, ""), move), "")


def email(key: Key, match: Column) -> Column:
    """The domain and the punctuation stay; letters and digits keep their kind."""
    name = F.substring_index(match, "@", 1)
    half = _div(F.length(name), F.lit(2)).cast("int")
    start = F.struct(F.substr(name, F.lit(1), half).alias("x"), F.substr(name, half + 1).alias("y"))

    def turn(state: Column, i: Column) -> Column:
        x, y = state["x"], state["y"]
        even = i % 2 == 0
        return F.struct(
            F.when(even, x).otherwise(_shifted(key, x, i, y)).alias("x"),
            F.when(even, _shifted(key, y, i, x)).otherwise(y).alias("y"),
        )

    moved = F.aggregate(key.turns(), start, turn, lambda s: F.concat(s["x"], s["y"]))
    return F.concat(moved, F.substr(match, F.length(name) + 1))


KINDS = ("email", "ip", "date", "ssn", "card", "phone")
VALID = {"ip": is_ip, "date": is_date, "ssn": is_ssn, "card": is_card, "phone": is_phone}
REPLACE = {"email": email, "ip": ip, "date": date, "ssn": ssn, "card": card, "phone": phone}


def kind_of(match: Column) -> Column:
    """The kind of a valid candidate, else NULL."""
    out = F.when(match.contains("@"), F.lit("email"))
    for kind in KINDS[1:]:
        out = out.when(VALID[kind](match), F.lit(kind))
    return out


def pseudonym(key: Key, match: Column, kind: Column) -> Column:
    """The candidate's pseudonym; itself if it is not valid."""
    out = match
    for name in reversed(KINDS):
        out = F.when(kind == name, REPLACE[name](key, match)).otherwise(out)
    return out


def pseudonymize(docs: DataFrame, text_col: str = "text", key: Key = Key()) -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``found_<kind>`` counts behind all columns.

    All rows stay, in any number. NULL and empty texts, and texts without a valid
    value, stay as they are with counts of zero. Candidates that fail validation
    (a wrong check digit, month 13, octet 300) are left alone. Columns named like
    a count are replaced by it; all others stay, whatever their names.
    """
    taken = {c.lower() for c in docs.columns}
    found_col, kinds_col = (next(n for i in count() if (n := f"{stem}_{i}") not in taken) for stem in ("found", "kinds"))
    text = F.col(f"`{text_col}`")
    held = docs.withColumn(found_col, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)))
    held = held.withColumn(
        kinds_col,
        F.when(F.size(found_col) > 0, F.transform(found_col, kind_of)).otherwise(
            F.array().cast("array<string>")
        ),
    )
    valid = F.exists(kinds_col, lambda kind: kind.isNotNull())
    values = F.zip_with(
        found_col, kinds_col, lambda match, kind: F.coalesce(pseudonym(key, match, kind), match)
    )
    pieces = F.zip_with(
        F.split(text, CANDIDATE, -1), values,
        lambda gap, value: F.concat(gap, F.coalesce(value, F.lit(""))),
    )
    held = held.withColumn(text_col, F.when(valid, F.array_join(pieces, "")).otherwise(text))

    def held_of(kind: str) -> Column:
        return F.size(F.filter(kinds_col, lambda k: k == kind)).cast("bigint")

    counts = {f"found_{kind}": held_of(kind) for kind in KINDS}
    return held.withColumns(counts).drop(found_col, kinds_col)
