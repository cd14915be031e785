"""Format-preserving pseudonyms for personal numbers, dates and addresses.

A value that is valid in its format is read as a number (or, for mail addresses, as
characters), permuted by a keyed Feistel network over exactly the format's domain, and
written back in the same format. Equal values get equal pseudonyms in every document,
different values different ones, and the holder of the key can turn them back. Dates are
permuted among those that can be written in the same shape (which part comes first, one
digit or two for day and month), so every shape is a permutation of its own. What merely
looks like such a value stays. Everything is DataFrame functions on the row.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.markup import let

ROUNDS = 8

# The characters of an IBAN after its check digits, by country.
_ACCOUNTS = {
    11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH HR LI LV", 18: "BG BH CR DE GB GE IE ME RS VA",
    19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG", 21: "AO CV GW LY MZ PT ST", 22: "DZ IR IS TR",
    23: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD", 24: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 25: "BR EG PS QA UA",
    26: "JO KW MU YE", 27: "MT SC", 28: "LC", 29: "RU",
}
_IBANS = "|".join(
    f"(?:{'|'.join(codes.split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4}}}" + (f" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])" for n, codes in _ACCOUNTS.items()
)
# A whole written-out card number, which is no part of a phone number before it.
_CARD_NEXT = r" (?:[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4} [0-9]{6} [0-9]{5})(?! ?[0-9])"
# Letters of names in addresses. Scripts written without spaces are left out: their words would run into an address.
_LETTER = r"A-Za-z0-9À-ÖØ-öø-ɏ̀-ͯΆΈ-ϿЀ-џḀ-ỿ"
# The formats, each a pattern that cannot run on past a long word.
PATTERNS = {
    "email": rf"(?<![{_LETTER}._%+-])[{_LETTER}._%+-]{{1,64}}+@[{_LETTER}-]++(?:\.[{_LETTER}-]++)++",
    "date": r"(?<![0-9-])(?:1[7-9]|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2}(?![0-9-])"
    r"|(?<![0-9/])[0-9]{1,2}/[0-9]{1,2}/(?:1[7-9]|20)[0-9]{2}(?![0-9])|(?<![0-9.])[0-9]{1,2}[.][0-9]{1,2}[.](?:1[7-9]|20)[0-9]{2}(?![0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": rf"(?<![A-Za-z0-9])(?:{_IBANS}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![A-Za-z0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    rf"|(?<![0-9+])\+[0-9]{{1,3}}[ .-]?(?:\([0-9]{{1,4}}\)[ .-]?)?[0-9]{{2,4}}(?:(?!{_CARD_NEXT})[ .-]?[0-9]{{2,4}}){{1,4}}(?![0-9])"
    r"|(?<![0-9+]|[0-9+][ .-])(?:1[ .-])?(?:\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}[.][0-9]{3}[.][0-9]{4})(?![0-9]|[.-][0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}"
    r"|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9])",
}
ANY = "|".join(PATTERNS.values())
# What every match of ANY holds: four digits with little between them, the head of an account number, or an at sign.
HINT = r"@|[0-9](?:[ ./()-]{0,2}[0-9]){3}|[A-Z]{2}[0-9]{2}"
# Days of the months of a common year; dates are of 400 years, a whole Gregorian cycle, from this one on.
MONTHS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)
YEAR_ZERO, YEARS = 1700, 400
LEAP_YEARS = [y for y in range(YEAR_ZERO, YEAR_ZERO + YEARS) if y % 4 == 0 and (y % 100 or y % 400 == 0)]
# Where blocks of letters beyond ASCII begin, and how many letters they hold.
LETTERS = (
    (0xC0, 23), (0xD8, 7), (0xDF, 24), (0xF8, 8), (0x100, 128), (0x180, 208), (0x391, 17), (0x3A3, 7), (0x3AC, 5), (0x3B1, 25), (0x3CA, 5),
    (0x400, 16), (0x410, 32), (0x430, 32), (0x450, 16), (0x1E00, 256),
)
# 898 * 989901 social security numbers are valid; area and exchange of a national phone number are 200 to 999.
SSN_AREAS, SSN_REST = 898, 99 * 9999
EXCHANGES, LINES = 800, 10_000


def _draw(key: str, tweak: str | Column, turn: int, half: Column, below: Column | int) -> Column:
    """A keyed number under `below` (at most 10^10) from the other half."""
    digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit(tweak) if isinstance(tweak, str) else tweak, F.lit(str(turn)), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), below)


def permuted(number: Column, a: Column, b: Column, key: str, tweak: str | Column, back: bool = False) -> Column:
    """A keyed permutation of 0 .. a*b - 1 (each of a, b at most 10^10): one part at a time is shifted by a draw from the other."""
    pair = F.struct(F.floor(number / b).cast("bigint").alias("x"), F.pmod(number, b).alias("y"))
    sign = -1 if back else 1

    def turned(p: Column, turn: int) -> Column:
        if turn % 2:
            return F.struct(p["x"].alias("x"), F.pmod(p["y"] + sign * _draw(key, tweak, turn, p["x"], b), b).alias("y"))
        return F.struct(F.pmod(p["x"] + sign * _draw(key, tweak, turn, p["y"], a), a).alias("x"), p["y"].alias("y"))

    def run(p: Column, turns: list[int]) -> Column:
        if not turns:
            return p["x"] * b + p["y"]
        return let(turned(p, turns[0]), lambda q: run(q, turns[1:]))

    turns = list(range(ROUNDS))
    return let(pair, lambda p: run(p, turns[::-1] if back else turns))


def _whole(number: str | Column) -> Column:
    return F.lit(number).cast("bigint") if isinstance(number, (str, int)) else number.cast("bigint")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _permuted_digits(digits: Column, key: str, tweak: str, back: bool) -> Column:
    """2 to 18 digits to as many others."""
    n = F.char_length(digits)
    low = F.floor(n / 2).cast("int")
    power = lambda e: F.rpad(F.lit("1"), e + 1, "0").cast("bigint")
    made = let(power(n - low), lambda a: let(power(low), lambda b: permuted(digits.cast("bigint"), a, b, key, tweak, back)))
    return F.lpad(made.cast("string"), n, "0")


def _refilled(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced, in order, by `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("next"))

    def step(done: Column, char: Column) -> Column:
        is_digit = char.between("0", "9")
        return F.struct(
            F.concat(done["out"], F.when(is_digit, F.substring(digits, done["next"], F.lit(1))).otherwise(char)).alias("out"),
            (done["next"] + is_digit.cast("int")).alias("next"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda done: done["out"])


def luhn_digit(payload: Column) -> Column:
    """The check digit that makes payload + digit a valid card number."""

    def weight(char: Column, i: Column) -> Column:
        doubled = char.cast("int") * 2
        return F.when(i % 2 == 0, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(char.cast("int"))

    total = F.aggregate(F.transform(F.split(F.reverse(payload), ""), weight), F.lit(0), lambda s, x: s + x)
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def iban_check(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN."""

    def value(char: Column) -> Column:
        letter = F.ascii(char) - F.lit(55)
        return F.when(char.between("0", "9"), F.struct(F.lit(10).alias("m"), char.cast("int").alias("v"))).otherwise(
            F.struct(F.lit(100).alias("m"), letter.alias("v"))
        )

    chars = F.transform(F.split(F.concat(account, country, F.lit("00")), ""), value)
    rest = F.aggregate(chars, F.lit(0), lambda r, x: F.pmod(r * x["m"] + x["v"], F.lit(97)))
    return F.lpad((98 - rest).cast("string"), 2, "0")


def _card(value: Column, key: str, back: bool) -> Column:
    def of(d: Column) -> Column:
        payload = F.substring(d, F.lit(1), F.char_length(d) - 1)
        fresh = let(_permuted_digits(payload, key, "card", back), lambda p: F.concat(p, luhn_digit(p)))
        return F.when(F.substring(d, -1, 1) == luhn_digit(payload), let(fresh, lambda f: _refilled(value, f)))

    return let(_digits(value), of)


def _phone(value: Column, key: str, back: bool) -> Column:
    """With a country code, that stays, and 7 to 15 digits in all are a phone number; without one, ten digits of the national plan are."""

    def national(d: Column) -> Column:
        area, exchange, line = (F.substring(d, at, n).cast("bigint") for at, n in ((-10, 3), (-7, 3), (-4, 4)))
        number = ((area - 200) * EXCHANGES + exchange - 200) * LINES + line
        side = _whole(EXCHANGES * 100)  # areas are as many as exchanges, so both sides are equal

        def written(n: Column) -> Column:
            front = F.floor(n / LINES).cast("bigint")
            pad = lambda x, width: F.lpad(x.cast("bigint").cast("string"), width, "0")
            parts = (F.floor(front / EXCHANGES) + 200, F.pmod(front, _whole(EXCHANGES)) + 200, F.pmod(n, _whole(LINES)))
            return F.concat(F.substring(d, F.lit(1), F.char_length(d) - 10), *map(pad, parts, (3, 3, 4)))

        fresh = let(permuted(number, side, side, key, "national", back), written)
        return F.when((area >= 200) & (exchange >= 200), let(fresh, lambda f: _refilled(value, f)))

    def of(d: Column) -> Column:
        code = F.char_length(F.regexp_extract(value, r"^\+([0-9]{1,3})(?=[ .(-])", 1))
        code = F.when(code > 0, code).otherwise(1)
        local = F.substring(d, code + 1, F.char_length(d))
        fresh = F.concat(F.substring(d, F.lit(1), code), _permuted_digits(local, key, "phone", back))
        return F.when(F.char_length(d).between(7, 15), let(fresh, lambda f: _refilled(value, f)))

    return let(_digits(value), lambda d: F.when(value.startswith("+"), of(d)).otherwise(national(d)))


def _ip(value: Column, key: str, back: bool) -> Column:
    def of(parts: Column) -> Column:
        number = F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, x: n * 256 + x)
        side = F.lit(65536).cast("bigint")
        octets = lambda n: F.array_join(F.transform(F.lit([24, 16, 8, 0]), lambda s: F.pmod(F.floor(n / F.pow(F.lit(2.0), s)).cast("bigint"), F.lit(256)).cast("string")), ".")
        return F.when(F.array_max(parts) < 256, let(permuted(number, side, side, key, "ip", back), octets))

    return let(F.transform(F.split(value, r"\."), lambda x: x.cast("bigint")), of)


def _ssn(value: Column, key: str, back: bool) -> Column:
    area, group, serial = (F.substring(value, at, n).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4)))
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    number = place * SSN_REST + (group - 1) * 9999 + (serial - 1)

    def written(n: Column) -> Column:
        at = F.floor(n / SSN_REST).cast("bigint")
        rest = F.pmod(n, _whole(SSN_REST))
        pad = lambda x, width: F.lpad(x.cast("bigint").cast("string"), width, "0")
        return F.concat_ws("-", pad(F.when(at >= 665, at + 2).otherwise(at + 1), 3), pad(F.floor(rest / 9999) + 1, 2), pad(F.pmod(rest, _whole(9999)) + 1, 4))

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, let(permuted(number, _whole(SSN_AREAS), _whole(SSN_REST), key, "ssn", back), written))


def _iban(value: Column, key: str, back: bool) -> Column:
    """The country and the account's letters stay, all digits of the account are permuted, check digits are made anew."""

    def renumbered(d: Column) -> Column:
        n = F.char_length(d)
        # More than 18 digits are permuted in two halves.
        cut = F.ceil(n / 2).cast("int")
        first, last = F.substring(d, F.lit(1), cut), F.substring(d, cut + 1, n)
        return F.when(n > 18, F.concat(_permuted_digits(first, key, "iban-bank", back), _permuted_digits(last, key, "iban", back))).otherwise(
            _permuted_digits(d, key, "iban", back)
        )

    def of(v: Column) -> Column:
        country, account = F.substring(v, 1, 2), F.substring(v, F.lit(5), F.char_length(v))
        fresh = let(let(_digits(account), renumbered), lambda d: let(_refilled(account, d), lambda a: F.concat(country, iban_check(country, a), a)))
        spaced = lambda f: F.when(value.contains(" "), F.rtrim(F.regexp_replace(f, "(.{4})", "$1 "))).otherwise(f)
        return F.when((F.substring(v, 3, 2) == iban_check(country, account)) & (F.char_length(_digits(account)) > 1), let(fresh, spaced))

    return let(F.regexp_replace(value, " ", ""), of)


def _factors(n: int) -> tuple[int, int]:
    """The most even a * b = n, or n - 1 where n is prime."""
    a = next(a for a in range(isqrt(n), 0, -1) if n % a == 0)
    return (a, n // a) if a > 1 else _factors(n - 1)


def _date_shapes() -> list[tuple[str, int, int, int, int]]:
    """For each shape: the days of a common year it can write, their number, the number of dates, and its two factors.

    Shapes in order: month and day of two digits each, a one-digit day, a one-digit
    month, both one-digit; then, month first, two-digit and one-digit months, where only
    days above 12 tell that the month is first.
    """
    shapes = []
    for months, days in ((12, 31), (12, 9), (9, 31), (9, 9), (12, -31), (9, -31)):
        low = 13 if days < 0 else 1
        year = [f"{m:02}-{d:02}" for m in range(1, months + 1) for d in range(low, min(abs(days), MONTHS[m - 1]) + 1)]
        dates = len(year) * YEARS + (len(LEAP_YEARS) if abs(days) == 31 else 0)
        shapes.append((" ".join(year), len(year), dates, *_factors(dates)))
    return shapes


def _date(value: Column, key: str, back: bool) -> Column:
    """Years 1700 to 2099: year first, or day before month, or month before day where only that is a date.

    A shape's dates are numbered by year and day of a common year, its 29ths of February
    after all others. Where their number is prime, the last one changes places with a
    date that the key draws.
    """
    whole = lambda numbers: F.array(*map(_whole, numbers))
    years, sizes, dates, lefts, rights = zip(*_date_shapes())
    leap_years = F.split(F.lit(" ".join(map(str, LEAP_YEARS))), " ")

    def two(part: Column) -> Column:
        return F.lpad(part, 2, "0")

    def of(p: Column) -> Column:
        iso = F.char_length(p[0]) == 4
        month_first = ~iso & (p[1].cast("int") > 12)
        year = F.when(iso, p[0]).otherwise(p[2])
        month = F.when(month_first, p[0]).otherwise(p[1])
        day = F.when(iso, p[2]).when(month_first, p[1]).otherwise(p[0])
        at = (F.char_length(month) == 1).cast("int") * F.when(month_first, 1).otherwise(2) + F.when(month_first, 4).otherwise((F.char_length(day) == 1).cast("int"))
        read = F.struct(year.alias("year"), month.alias("month"), day.alias("day"), at.alias("at"), iso.alias("iso"), month_first.alias("month_first"))
        return let(read, shaped)

    def shaped(d: Column) -> Column:
        named = {"days": F.split(F.get(F.array(*map(F.lit, years)), d["at"]), " ")}
        named |= {name: F.get(whole(numbers), d["at"]) for name, numbers in (("size", sizes), ("dates", dates), ("a", lefts), ("b", rights))}
        return let(F.struct(*(c.alias(name) for name, c in named.items())), lambda s: moved(d, s))

    def moved(d: Column, s: Column) -> Column:
        place = F.array_position(s["days"], F.concat(two(d["month"]), F.lit("-"), two(d["day"])))
        leap = F.when((two(d["month"]) == "02") & (d["day"] == "29"), F.array_position(leap_years, d["year"]))
        number = F.when(place > 0, (d["year"].cast("bigint") - YEAR_ZERO) * s["size"] + place - 1).when(leap > 0, s["size"] * YEARS + leap - 1)
        tweak = F.concat(F.lit("date"), d["at"].cast("string"))
        last = s["a"] * s["b"]

        def swapped(n: Column) -> Column:
            spot = _draw(key, tweak, ROUNDS, F.lit("last"), last)
            return F.when(last == s["dates"], n).otherwise(let(spot, lambda x: F.when(n == last, x).when(n == x, last).otherwise(n)))

        def inside(n: Column) -> Column:
            return F.when(n < last, permuted(n, s["a"], s["b"], key, tweak, back)).otherwise(n)

        fresh = let(number, lambda n: let(swapped(n), inside) if back else let(inside(n), swapped))
        return F.when(number.isNotNull(), let(fresh, lambda n: written(n, d, s)))

    def written(n: Column, d: Column, s: Column) -> Column:
        usual = n < s["size"] * YEARS
        year = F.when(usual, (F.floor(n / s["size"]) + YEAR_ZERO).cast("string")).otherwise(F.get(leap_years, (n - s["size"] * YEARS).cast("int")))
        both = F.when(usual, F.get(s["days"], F.pmod(n, s["size"]).cast("int"))).otherwise(F.lit("02-29"))
        month, day = F.right(F.substring(both, 1, 2), F.char_length(d["month"])), F.right(F.substring(both, 4, 2), F.char_length(d["day"]))
        mark = F.regexp_extract(value, "[-/.]", 0)
        return F.when(d["iso"], F.concat(year, mark, month, mark, day)).when(d["month_first"], F.concat(month, mark, day, mark, year)).otherwise(F.concat(day, mark, month, mark, year))

    return let(F.split(value, "[-/.]"), of)


def _email(value: Column, key: str, back: bool) -> Column:
    """The domain stays. Letters and digits of the name's halves are shifted in turn, each inside its own alphabet.

    Marks stay, those that stand above a letter as a character of their own included.
    """
    blocks = F.array(*(F.struct(F.lit(zero).alias("zero"), F.lit(n).alias("n")) for zero, n in LETTERS))
    name, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)

    def shifted(half: Column, other: Column, turn: int) -> Column:
        digest = F.sha2(F.concat_ws(":", F.lit(key), F.lit("email"), F.lit(str(turn)), other), 256)

        def one(char: Column, i: Column, stream: Column) -> Column:
            by = F.conv(F.substring(stream, F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int") * (-1 if back else 1)
            turn_in = lambda zero, n: F.char(F.pmod(F.ascii(char) - zero + by, F.lit(n)) + zero)

            def beyond(block: Column) -> Column:
                point = F.pmod(F.ascii(char) - block["zero"] + by, block["n"]) + block["zero"]
                return F.coalesce(F.decode(F.unhex(F.lpad(F.hex(point), 4, "0")), "UTF-16BE"), char)

            return (
                F.when(char.between("0", "9"), turn_in(48, 10))
                .when(char.between("a", "z"), turn_in(97, 26))
                .when(char.between("A", "Z"), turn_in(65, 26))
                .when(char < "\x80", char)
                .otherwise(let(F.get(F.filter(blocks, lambda r: (F.ascii(char) >= r["zero"]) & (F.ascii(char) < r["zero"] + r["n"])), F.lit(0)), beyond))
            )

        moved = let(digest, lambda s: F.transform(F.split(half, ""), lambda c, i: one(c, i, s)))
        return F.when(half == "", half).otherwise(F.array_join(moved, ""))

    def run(p: Column, turns: list[int]) -> Column:
        if not turns:
            return F.concat(p["x"], p["y"])
        x, y = p["x"], p["y"]
        q = F.struct(x.alias("x"), shifted(y, x, turns[0]).alias("y")) if turns[0] % 2 else F.struct(shifted(x, y, turns[0]).alias("x"), y.alias("y"))
        return let(q, lambda z: run(z, turns[1:]))

    cut = F.floor(F.char_length(name) / 2).cast("int")
    halves = F.struct(F.substring(name, F.lit(1), cut).alias("x"), F.substring(name, cut + 1, F.char_length(name)).alias("y"))
    turns = list(range(4))
    return F.concat(let(halves, lambda p: run(p, turns[::-1] if back else turns)), F.lit("@"), domain)


_MAKERS = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "iban": _iban, "phone": _phone, "card": _card}
KINDS = tuple(_MAKERS)


def pseudonym(value: Column, key: str, back: bool = False) -> Column:
    """`struct<kind, value>`: the first format that the value matches whole and is valid in; kind null, and the value itself, if none."""

    def named(kind: str) -> Column:
        fresh = F.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), _MAKERS[kind](value, key, back))
        return let(fresh, lambda x: F.when(x.isNotNull(), F.struct(F.lit(kind).alias("kind"), x.alias("value"))))

    return F.coalesce(*map(named, KINDS), F.struct(F.lit(None).cast("string").alias("kind"), value.alias("value")))


def pseudonymised(text: Column, key: str, back: bool = False) -> Column:
    """`struct<text, kinds: array<string>>`: the text with its personal values replaced, and the kind of each; null for null."""

    def of(found: Column) -> Column:
        pieces = F.zip_with(F.split(text, ANY, -1), found, lambda p, m: F.concat(p, F.coalesce(m["value"], F.lit(""))))
        return F.struct(F.array_join(pieces, "").alias("text"), F.array_compact(F.transform(found, lambda m: m["kind"])).alias("kinds"))

    matches = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: pseudonym(m, key, back))
    bare = F.struct(text.alias("text"), F.array().cast("array<string>").alias("kinds"))
    return F.when(text.rlike(HINT) & text.rlike(ANY), let(matches, of)).otherwise(bare)


def pseudonyms(docs: DataFrame, key: str, back: bool = False) -> DataFrame:
    """doc_id, `text` with pseudonyms, how many values were replaced, and of which kinds.

    `docs` needs doc_id and text; other columns are left aside. Null texts stay null and
    have none; empty texts stay; repeated rows are each done; no rows give no rows. Letters
    of a mail name that are neither Latin, Greek nor Cyrillic end the name. With
    `back` and the same key the original texts come back.
    """
    made = docs.select("doc_id", pseudonymised(F.col("text"), key, back).alias("made"))

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("made.kinds", lambda k: k == kind)), F.lit(0)).cast("long").alias(f"n_{kind}")

    return made.select("doc_id", F.col("made.text").alias("text"), F.coalesce(F.size("made.kinds"), F.lit(0)).cast("long").alias("n_replaced"), *map(count, KINDS))
