"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Found values are validated (check digits, calendar, ranges) and permuted within their format by a
keyed Feistel network over mixed radices: a card number becomes another valid card number, a date
another date, an address another address. Equal values get equal pseudonyms in all documents, however
they are separated or ordered, and different values different ones. Values that are not valid stay.

A value is a list of digits, each with a radix of its own. The network adds to one half, digit by
digit and modulo its radix, what SHA-512 makes of the key, the round and the other half, and then
changes the halves over.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
# Within 28 years dates repeat their weekdays, and no block below meets a century without a leap day.
FIRST_YEAR, LAST_YEAR, BLOCK_YEARS, BLOCK_DAYS = 1901, 2096, 28, 10_227
_DAY_RADICES = (21, 487)  # their product is BLOCK_DAYS
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ACCENTED = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýß"
_ALPHABETS = ("0123456789", _LOWER, _UPPER, _ACCENTED, _ACCENTED.replace("ß", "").upper())


class Kind(NamedTuple):
    name: str
    pattern: str


# The first kind that matches at a place counts. All but the first begin with a digit or bracket.
_EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]{1,64}+@[A-Za-z0-9][A-Za-z0-9\-]{0,62}(?:\.[A-Za-z0-9\-]{1,63}){1,8}+"
_NUMBERS = (
    Kind("date", r"(?<![\d./\-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})(?![\d/\-]|\.\d)"),
    Kind("ip", r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)"),
    Kind("ssn", r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"),
    Kind("phone", r"\+1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}(?!\d)"),
    Kind("phone", r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\))?(?:[ .\-]?(?!\d{1,3}(?:\.\d{1,3}){3})\d{2,4}){2,5}(?!\d)"),
    Kind("phone", r"(?<![\d+])\(\d{3}\) ?\d{3}[ .\-]\d{4}(?!\d)|(?<![\d+.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])"),
    Kind("card", r"(?<![0-9A-Za-z])(?:\d{13,19}+|\d{4}([ \-])\d{4}\1\d{4}\1\d{4}|\d{4}[ \-]\d{6}[ \-]\d{5})(?![0-9A-Za-z])"),
)
# ITU country codes: two of one digit, those of two digits, and all others have three.
_COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
NUMBER = "(?=[0-9+(])(?:" + "|".join(f"(?:{k.pattern})" for k in _NUMBERS) + ")"
ANY = f"(?:{NUMBER}|{_EMAIL})"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _hex_at(digest: Column, place: Column) -> Column:
    """Four hex digits of a digest as a number; a digest of 128 serves 32 places and then repeats."""
    return F.conv(F.substring(digest, F.pmod(place, F.lit(32)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def permuted(digits: Column, radices: Column, key: str, tweak: str) -> Column:
    """The digits (array of int) permuted among all lists of digits with these radices. A list of one
    digit is shifted by an amount that the key and the radix decide."""
    n = F.size(digits)
    half = (n / 2).cast("int")

    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        moving = F.when(even, state["l"]).otherwise(state["r"])
        fixed = F.when(even, state["r"]).otherwise(state["l"])
        radix = F.when(even, state["lr"]).otherwise(state["rr"])
        text = F.concat(F.lit(f"{key}|{tweak}|"), n.cast("string"), F.lit("|"), i.cast("string"), F.lit("|"),
                        F.array_join(fixed.cast("array<string>"), ","))
        moved = _let(F.sha2(text, 512), lambda digest: F.transform(
            moving, lambda d, at: ((d + _hex_at(digest, at)) % radix[at]).cast("int")
        ))
        return F.struct(
            F.when(even, moved).otherwise(state["l"]).alias("l"), F.when(even, state["r"]).otherwise(moved).alias("r"),
            state["lr"].alias("lr"), state["rr"].alias("rr"),
        )

    start = F.struct(
        F.slice(digits, F.lit(1), half).alias("l"), F.slice(digits, half + 1, n - half).alias("r"),
        F.slice(radices, F.lit(1), half).alias("lr"), F.slice(radices, half + 1, n - half).alias("rr"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"]))


def _digits(text: Column) -> Column:
    return F.split(F.regexp_replace(text, r"\D", ""), "").cast("array<int>")


def _of_same_radix(digits: Column, radix: int, key: str, tweak: str) -> Column:
    return _let(digits, lambda d: permuted(d, F.array_repeat(F.lit(radix), F.size(d)), key, tweak))


def _refilled(shape: Column, digits: Column) -> Column:
    """The shape with its digits replaced in order; all else stays."""
    chars = F.split(shape, "")
    start = F.struct(F.lit("").alias("text"), F.lit(0).alias("used"))

    def step(state: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct(
            F.concat(state["text"], F.when(is_digit, digits[state["used"]].cast("string")).otherwise(c)).alias("text"),
            (state["used"] + is_digit.cast("int")).alias("used"),
        )

    return F.aggregate(chars, start, step, lambda s: s["text"])


def _luhn_sum(digits: Column) -> Column:
    """Weighted sum of the digits before the check digit, which is not among them."""
    doubled = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _card(text: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        payload = F.slice(d, F.lit(1), F.size(d) - 1)
        check = lambda p: F.pmod(F.lit(10) - _luhn_sum(p) % 10, F.lit(10))
        valid = (F.element_at(d, -1) == check(payload)) & (F.aggregate(d, F.lit(0), lambda a, x: a + x) > 0)
        new = _let(_of_same_radix(payload, 10, key, "card"), lambda p: _refilled(text, F.concat(p, F.array(check(p).cast("int")))))
        return F.when(valid, new).otherwise(text)

    return _let(_digits(text), of)


def _phone(text: Column, key: str) -> Column:
    """The country code after a plus stays; digits alone decide how long it is, not separators."""
    def of(digits: Column) -> Column:
        code = F.when(text.startswith("+"), F.regexp_extract(digits, _COUNTRY, 0)).otherwise("")
        new = _let(code, lambda c: F.concat(
            F.filter(F.split(c, ""), lambda d: d != "").cast("array<int>"),
            _of_same_radix(_digits(F.substring(digits, F.length(c) + 1, F.length(digits))), 10, key, "phone"),
        ))
        return F.when(F.length(digits).between(8, 15), _let(new, lambda d: _refilled(text, d))).otherwise(text)

    return _let(F.regexp_replace(text, r"\D", ""), of)


def _ip(text: Column, key: str) -> Column:
    def of(o: Column) -> Column:
        pair = F.array(o[0] * 256 + o[1], o[2] * 256 + o[3])
        new = _let(_of_same_radix(pair, 65_536, key, "ip"), lambda p: F.array_join(
            F.array(*[x.cast("string") for i in (0, 1) for x in ((p[i] / 256).cast("int"), p[i] % 256)]), "."))
        return F.when(F.forall(o, lambda x: x <= 255), new).otherwise(text)

    return _let(F.split(text, r"\.").cast("array<int>"), of)


def _ssn(text: Column, key: str) -> Column:
    def of(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        at = F.array((area - 1 - (area > 666).cast("int")), group - 1, serial - 1)
        radices = F.array(F.lit(898), F.lit(99), F.lit(9_999))
        new = _let(permuted(at, radices, key, "ssn"), lambda d: F.format_string(
            "%03d-%02d-%04d", d[0] + 1 + (d[0] >= 665).cast("int"), d[1] + 1, d[2] + 1))
        return F.when(valid, new).otherwise(text)

    return _let(F.split(text, "-").cast("array<int>"), of)


def _date(text: Column, key: str) -> Column:
    """Year-month-day, or day and month before the year; where the second number cannot be a month but
    the first can, the month comes first. Widths and separators stay where the new numbers fit."""
    iso = text.rlike(r"^\d{4}")
    parts = F.split(text, r"[./\-]").cast("array<int>")

    def of(p: Column) -> Column:
        month_first = ~iso & (p[1] > 12) & (p[0] <= 12)
        year = F.when(iso, p[0]).otherwise(p[2])
        month = F.when(month_first, p[0]).otherwise(p[1])
        day = F.when(iso, p[2]).when(month_first, p[1]).otherwise(p[0])
        date = F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")
        block = ((year - FIRST_YEAR) / BLOCK_YEARS).cast("int") * BLOCK_YEARS + FIRST_YEAR
        start = F.make_date(block, F.lit(1), F.lit(1))

        def moved(at: Column) -> Column:
            return permuted(F.array((at / _DAY_RADICES[1]).cast("int"), at % _DAY_RADICES[1]), F.array(*map(F.lit, _DAY_RADICES)), key, "date")

        def written(new: Column) -> Column:
            first = F.when(month_first, F.month(new)).otherwise(F.dayofmonth(new))
            second = F.when(month_first, F.dayofmonth(new)).otherwise(F.month(new))
            width = lambda group, value: F.when(
                F.length(F.regexp_extract(text, r"^(\d+)\D(\d+)", group)) == 2, F.lpad(value.cast("string"), 2, "0")
            ).otherwise(value.cast("string"))
            mark = F.regexp_extract(text, r"^\d+(\D)\d+(\D)", 1), F.regexp_extract(text, r"^\d+(\D)\d+(\D)", 2)
            local = F.concat(width(1, first), mark[0], width(2, second), mark[1], F.year(new).cast("string"))
            return F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(local)

        new = _let(moved(F.datediff(date, start)), lambda d: F.date_add(start, d[0] * _DAY_RADICES[1] + d[1]))
        return F.when(date.isNotNull() & year.between(FIRST_YEAR, LAST_YEAR), _let(new, written)).otherwise(text)

    return _let(parts, of)


def _email(text: Column, key: str) -> Column:
    """The part before the at sign, each character within its own alphabet; the domain stays."""
    name, domain = F.substring_index(text, "@", 1), F.regexp_extract(text, "@.*$", 0)
    chars = F.transform(F.split(name, ""), _coded)
    return _let(chars, lambda cs: F.concat(
        _let(
            permuted(F.transform(cs, lambda c: c["at"]), F.transform(cs, lambda c: F.length(c["letters"])), key, "email"),
            lambda d: F.array_join(F.zip_with(cs, d, lambda c, i: F.substring(c["letters"], i + 1, F.lit(1))), ""),
        ),
        domain,
    ))


def _coded(c: Column) -> Column:
    """The alphabet a character belongs to, itself alone if none, and its place in it."""
    letters = c
    for alphabet in _ALPHABETS:
        letters = F.when(F.instr(F.lit(alphabet), c) > 0, F.lit(alphabet)).otherwise(letters)
    return _let(letters, lambda a: F.struct(a.alias("letters"), (F.instr(a, c) - 1).alias("at")))


_PSEUDONYM = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone, "card": _card}


def kind_of(value: Column) -> Column:
    """The kind of a found value, from its form alone."""
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{4})$"), "date")
        .when(value.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(value.rlike(r"^(?:\+|\()|^\d{3}([.\-])\d{3}[.\-]\d{4}$"), "phone")
        .otherwise("card")
    )


def pseudonym(value: Column, key: str) -> Column:
    def of(kind: Column) -> Column:
        new = value
        for name, write in _PSEUDONYM.items():
            new = F.when(kind == name, write(value, key)).otherwise(new)
        return new

    return _let(kind_of(value), of)


def pseudonymised(text: Column, key: str) -> Column:
    """Struct of the ``text`` with every found value replaced, and of the ``found`` and the ``new``
    values in order."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    gaps = F.split(text, ANY, -1)

    def joined(values: Column) -> Column:
        new = F.transform(values, lambda v: pseudonym(v, key))
        return _let(new, lambda n: F.struct(
            F.array_join(F.zip_with(gaps, n, lambda gap, v: F.concat(gap, F.coalesce(v, F.lit("")))), "").alias("text"),
            values.alias("found"), n.alias("new"),
        ))

    unchanged = F.struct(text.alias("text"), F.array().cast("array<string>").alias("found"), F.array().cast("array<string>").alias("new"))
    # Most texts hold neither digits nor addresses, or no such value: the rest runs on the others only.
    worth = (text.rlike("[0-9]") & text.rlike(NUMBER)) | text.contains("@") & text.rlike(_EMAIL)
    return F.when(worth, _let(found, joined)).otherwise(unchanged)


def with_pseudonyms(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """``docs`` with the values found in a text column replaced; a null text stays null. Rows, their
    number and all other columns stay as they are."""
    new = pseudonymised(docs[column], key)["text"].alias(column)
    return docs.select(*[new if c == column else docs[c] for c in docs.columns])


def report(docs: DataFrame, key: str) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the new ``text``, the values ``found`` in the old one and the
    ``new`` ones, in order. Without a text, ``text`` is null and the lists are empty."""
    done = docs.select(docs["doc_id"], pseudonymised(docs["text"], key).alias("done"))
    return done.select("doc_id", "done.text", "done.found", "done.new")
