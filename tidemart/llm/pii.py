"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Each validated value is an integer below ``a * b`` for its format. A Feistel
network with modular halves (l < a, r < b) and keyed SHA-256 rounds permutes
exactly that range, so a card stays a valid card and a date a date, no two values
meet, and equal values stay equal in all documents. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm._common import free_name

ROUNDS = 8
FOUND = "array<struct<kind:string,text:string>>"
DAYS = 146_097  # of 400 Gregorian years; 27 * 5411
FIRST_DAY, LAST_DAY = "1800-01-01", "2199-12-31"

# What may hold a value; a cheap test that spares most texts the full pattern.
HINT = r"[0-9@]"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": r"(?=[0-9a-fA-F]{16})(?<=(?:token|secret|password|key)\s{0,3}[=:]\s{0,3}[\"']?)[0-9a-fA-F]{16,}+",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "date": r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4})"
    r"(?![\w/-]|\.[0-9])",
    "ip": r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9])",
    "phone": r"(?<![\w+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[.-])"
    r"[0-9]{3}[ .-][0-9]{4}(?![\w-])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?<![\w-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![\w-])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out, and written into the plan, once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _noise(key: str, *parts: Column) -> Column:
    """60 keyed bits."""
    said = F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)
    return F.conv(F.substring(said, 1, 15), 16, 10).cast("bigint")


def feistel(value: Column, a: Column | int, b: Column | int, key: str, kind: str) -> Column:
    """A keyed permutation of the integers below ``a * b``; each below 2^31."""
    a, b = (x if isinstance(x, Column) else F.lit(x).cast("bigint") for x in (a, b))

    def step(s: Column, i: Column) -> Column:
        left = (s["l"] + _noise(key, F.lit(kind), i, s["r"]) % a) % a
        right = (s["r"] + _noise(key, F.lit(kind), i, s["l"]) % b) % b
        even = i % 2 == 0
        return F.struct(
            F.when(even, left).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(right).alias("r"),
        )

    # A multiple of b; rounding mends what doubles lose above 2^53.
    left = F.round((value - value % b) / b).cast("bigint")
    start = F.struct(left.alias("l"), (value % b).alias("r"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: s["l"] * b + s["r"]
    )


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    return F.aggregate(
        F.split(shape, ""),
        F.struct(F.lit("").alias("out"), digits.alias("rest")),
        lambda s, c: F.when(
            c.between("0", "9"),
            F.struct(
                F.concat(s["out"], F.substring(s["rest"], 1, 1)).alias("out"),
                s["rest"].substr(F.lit(2), F.length(s["rest"])).alias("rest"),
            ),
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["rest"].alias("rest"))),
        lambda s: s["out"],
    )


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum when the last digit is the check digit."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(digits), ""),
            lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
                (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")
            ),
        ),
        F.lit(0),
        lambda s, x: s + x,
    )


def is_card(digits: Column) -> Column:
    return (_luhn_sum(digits) % 10 == 0) & ~digits.rlike("^0+$")


def card_pseudonym(match: Column, key: str) -> Column:
    """All digits but the last are permuted; the last is the check digit anew."""

    def of(digits: Column) -> Column:
        n = F.length(digits) - 1
        low = F.floor(n / 2).cast("int")
        a, b = (F.pow(F.lit(10), k).cast("bigint") for k in (low, n - low))
        body = digits.substr(F.lit(1), n).cast("bigint")
        return F.lpad(feistel(body, a, b, key, "card").cast("string"), n, F.lit("0"))

    def checked(new: Column) -> Column:
        check = (10 - _luhn_sum(F.concat(new, F.lit("0"))) % 10) % 10
        return _refill(match, F.concat(new, check.cast("string")))

    return _let(_let(_digits(match), of), checked)


def phone_pseudonym(match: Column, key: str) -> Column:
    """The last ten digits change, the country code stays."""

    def of(digits: Column) -> Column:
        body = F.right(digits, F.lit(10)).cast("bigint")
        new = feistel(body, 100_000, 100_000, key, "phone").cast("string")
        return F.concat(digits.substr(F.lit(1), F.length(digits) - 10), F.lpad(new, 10, "0"))

    return _refill(match, _let(_digits(match), of))


def is_ssn(match: Column) -> Column:
    return match.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")


def ssn_pseudonym(match: Column, key: str) -> Column:
    """Areas 001-665 and 667-899, groups 01-99 and serials 0001-9999 only."""
    area, group, serial = (match.substr(i, n).cast("bigint") for i, n in ((1, 3), (5, 2), (8, 4)))
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    value = (place * 99 + group - 1) * 9999 + serial - 1

    def written(new: Column) -> Column:
        serial, rest = new % 9999 + 1, F.floor(new / 9999).cast("bigint")
        place = F.floor(rest / 99).cast("bigint")
        area = F.when(place >= 665, place + 2).otherwise(place + 1)
        parts = ((area, 3), (rest % 99 + 1, 2), (serial, 4))
        return F.concat_ws("-", *(F.lpad(x.cast("string"), n, "0") for x, n in parts))

    return _let(feistel(value, 898 * 99, 9999, key, "ssn"), written)


def is_ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda o: o.cast("int") <= 255)


def ip_pseudonym(match: Column, key: str) -> Column:
    value = F.aggregate(
        F.split(match, r"\."), F.lit(0).cast("bigint"), lambda s, o: s * 256 + o.cast("bigint")
    )

    def written(new: Column) -> Column:
        octets = (F.shiftright(new, n).bitwiseAND(F.lit(255)) for n in (24, 16, 8, 0))
        return F.concat_ws(".", *(o.cast("string") for o in octets))

    return _let(feistel(value, 65_536, 65_536, key, "ip"), written)


def _date_order(match: Column) -> Column:
    """(order, day) of the first reading that is a day; null if none is."""
    parts = F.split(match, "[-./]")

    def read(name: str, shape: str, y: int, m: int, d: int) -> Column:
        said = F.concat_ws("-", parts[y], F.lpad(parts[m], 2, "0"), F.lpad(parts[d], 2, "0"))
        day = F.try_to_timestamp(said, F.lit("yyyy-MM-dd")).cast("date")
        of = _let(
            day,
            lambda x: F.when(
                x.between(FIRST_DAY, LAST_DAY),
                F.struct(F.lit(name).alias("order"), x.alias("day")),
            ),
        )
        return F.when(match.rlike(shape), of)

    return F.coalesce(
        read("yyyy-MM-dd", "^[0-9]{4}-", 0, 1, 2),
        read("MM/dd/yyyy", "/", 2, 0, 1),
        read("dd/MM/yyyy", "/", 2, 1, 0),
        read("dd.MM.yyyy", "^[0-9]{1,2}[.]", 2, 1, 0),
    )


def date_pseudonym(match: Column, key: str) -> Column:
    """Another day of 1800 to 2199, written the same way; null if not a day."""

    def written(said: Column) -> Column:
        number = F.datediff(said["day"], F.lit(FIRST_DAY).cast("date")).cast("bigint")
        moved = feistel(number, 27, 5_411, key, "date").cast("int")
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), moved)
        parts = {
            "yyyy": F.year(day).cast("string"),
            "MM": F.lpad(F.month(day).cast("string"), 2, "0"),
            "dd": F.lpad(F.dayofmonth(day).cast("string"), 2, "0"),
        }
        return _let(
            F.struct(*(v.alias(k) for k, v in parts.items())),
            lambda d: F.when(
                said["order"] == "yyyy-MM-dd", F.concat_ws("-", d["yyyy"], d["MM"], d["dd"])
            )
            .when(said["order"] == "MM/dd/yyyy", F.concat_ws("/", d["MM"], d["dd"], d["yyyy"]))
            .when(said["order"] == "dd/MM/yyyy", F.concat_ws("/", d["dd"], d["MM"], d["yyyy"]))
            .when(said["order"] == "dd.MM.yyyy", F.concat_ws(".", d["dd"], d["MM"], d["yyyy"])),
        )

    return _let(_date_order(match), written)


def _iban_rest(iban: Column) -> Column:
    """The IBAN, without spaces, modulo 97 as its standard reads it."""
    moved = F.concat(iban.substr(F.lit(5), F.length(iban)), iban.substr(1, 4))
    return F.aggregate(
        F.split(moved, ""),
        F.lit(0),
        lambda s, c: F.when(c.between("0", "9"), (s * 10 + F.ascii(c) - 48) % 97).otherwise(
            (s * 100 + F.ascii(c) - 55) % 97
        ),
    )


def is_iban(match: Column) -> Column:
    return _iban_rest(F.replace(match, F.lit(" "))) == 1


def _shift(chars: Column, noise: Column, hexadecimal: bool) -> Column:
    """Each character moved within its class by a byte of ``noise`` (hex text)."""

    def move(noise: Column, c: Column, i: Column) -> Column:
        by = F.conv(noise.substr(i % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        if hexadecimal:
            at = F.instr(F.lit("0123456789abcdef"), F.lower(c)) - 1
            return F.lower(F.hex(((at + by) % 16).cast("bigint")))
        out = c
        for first, last in (("a", "z"), ("A", "Z"), ("0", "9")):
            size = ord(last) - ord(first) + 1
            moved = F.chr((F.ascii(c) - ord(first) + by) % size + ord(first))
            out = F.when(c.between(first, last) & (F.length(c) == 1), moved).otherwise(out)
        return out

    return _let(noise, lambda n: F.transform(chars, lambda c, i: move(n, c, i)))


def text_pseudonym(text: Column, key: str, kind: str, hexadecimal: bool = False) -> Column:
    """A keyed permutation of the texts that have this shape of letters and digits."""
    half = F.floor(F.length(text) / 2).cast("int")

    def step(s: Column, i: Column) -> Column:
        def noise(other: Column) -> Column:
            return F.sha2(
                F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.concat_ws("", other)),
                256,
            )

        even = i % 2 == 0
        left = _shift(s["l"], noise(s["r"]), hexadecimal)
        right = _shift(s["r"], noise(s["l"]), hexadecimal)
        return F.struct(
            F.when(even, left).otherwise(s["l"]).alias("l"),
            F.when(even, s["r"]).otherwise(right).alias("r"),
        )

    # split('') of an empty half is [''], which no step changes.
    start = F.struct(
        F.split(text.substr(F.lit(1), half), "").alias("l"),
        F.split(text.substr(half + 1, F.length(text)), "").alias("r"),
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        start,
        step,
        lambda s: F.concat(F.concat_ws("", s["l"]), F.concat_ws("", s["r"])),
    )


def iban_pseudonym(match: Column, key: str) -> Column:
    """Account characters permuted within their classes, check digits made anew."""

    def written(flat: Column) -> Column:
        return _let(
            text_pseudonym(flat.substr(F.lit(5), F.length(flat)), key, "iban"),
            lambda body: F.concat(
                flat.substr(1, 2),
                F.lpad(
                    (98 - _iban_rest(F.concat(flat.substr(1, 2), F.lit("00"), body))).cast("string"),
                    2,
                    "0",
                ),
                body,
            ),
        )

    return _let(
        _let(F.replace(match, F.lit(" ")), written),
        lambda new: F.when(
            match.contains(" "), F.trim(F.regexp_replace(new, "(.{4})", "$1 "))
        ).otherwise(new),
    )


def pseudonym(match: Column, key: str) -> Column:
    """(kind, text) for one match of the patterns; null where validation fails."""

    def is_(kind: str) -> Column:
        # Each pattern is the only one here: its group is the first.
        return match.rlike(f"^(?:{PATTERNS[kind]})$".replace(r"\2", r"\1"))

    def as_(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("text"))

    at = F.instr(match, "@")
    local, domain = match.substr(F.lit(1), at - 1), match.substr(at, F.length(match))
    digits = _digits(match)
    return (
        F.when(at > 0, as_("email", F.concat(text_pseudonym(local, key, "email"), domain)))
        .when(is_("ip") & is_ip(match), as_("ip", ip_pseudonym(match, key)))
        .when(
            is_("date") & _date_order(match).isNotNull(),
            as_("date", date_pseudonym(match, key)),
        )
        .when(is_("iban") & is_iban(match), as_("iban", iban_pseudonym(match, key)))
        .when(is_("ssn") & is_ssn(match), as_("ssn", ssn_pseudonym(match, key)))
        .when(is_("phone"), as_("phone", phone_pseudonym(match, key)))
        .when(is_("card") & is_card(digits), as_("card", card_pseudonym(match, key)))
        .when(
            match.rlike("^[0-9a-fA-F]{16,}$") & ~is_("card"),
            as_("secret", text_pseudonym(match, key, "secret", hexadecimal=True)),
        )
    )


def pseudonymise(
    docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii"
) -> DataFrame:
    """``docs`` with validated personal data replaced, and ``found_col``.

    ``found_col`` lists (kind, text), the new texts in order; a column of that name
    is replaced. Numbers that fail their check digits, octets over 255 and days
    that do not exist stay as they are. Null texts stay null with an empty list;
    empty texts stay empty. Rows are mapped one by one: repeats, ties and empty
    tables need no care, other columns pass through whatever their names. ``key`` is the secret.
    """
    text = F.col(text_col)
    pieces = F.split(text, ANY, -1)
    matches = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    news = F.transform(matches, lambda m: pseudonym(m, key))
    # Worked out once, then used for both columns.
    hit = F.when(
        text.rlike(HINT),
        F.struct(pieces.alias("pieces"), matches.alias("old"), news.alias("new")),
    )
    own = free_name(docs, "hit")
    made = docs.withColumn(own, hit)
    h = F.col(own)
    joined = F.array_join(
        F.transform(
            h["pieces"],
            lambda p, i: F.concat(
                p, F.coalesce(F.get(h["new"], i)["text"], F.get(h["old"], i), F.lit(""))
            ),
        ),
        "",
    )
    found = F.filter(h["new"], lambda x: x.isNotNull())
    return (
        made.withColumn(found_col, F.coalesce(found, F.array().cast(FOUND)))
        .withColumn(text_col, F.when(F.size(found) > 0, joined).otherwise(text))
        .drop(own)
    )

