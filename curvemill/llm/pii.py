"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Each kind of value is validated, mapped to a pair (left, right) of numbers below fixed
sizes, permuted by a keyed Feistel network on that pair, and written back in its old form.
The network is a permutation of the valid values of a form: equal values stay equal, other
values stay apart, and punctuation, lengths and check digits remain valid.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curvemill.llm.common import bind, fresh

TURNS = 4  # each changes the left, then the right number

# Forms of values, the first that fits counts. Fixed patterns; no value touches a letter or
# digit on either side.
FORMS = {
    "email": r"[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "date": r"(?:19|20)\d\d-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])"
            r"|(?:0?[1-9]|[12]\d|3[01])[./](?:0?[1-9]|[12]\d|3[01])[./](?:19|20)\d\d",
    "ssn": r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}",
    "phone": r"(?:\+?1[ .-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .-])[2-9]\d\d[ .-]\d{4}"
             r"|\+1[2-9]\d\d[2-9]\d{6}",
    "foreign": r"\+(?!1)[2-9]\d{0,2}(?:[ .-]?\(?\d{2,4}\)?){2,5}",
    "ip": r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)",
    "card": r"[2-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}",
    "iban": r"[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
}
START = r"(?<![A-Za-z0-9+])(?<![A-Za-z0-9][._%+-])"
END = r"(?![A-Za-z0-9])"
ANY = START + "(?:" + "|".join(FORMS.values()) + ")" + END
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
FIRST_DAY, LAST_DAY = "1900-01-01", "2099-12-31"
FIRST_YEAR, YEARS, FIRST_LEAP = 1900, 200, 1904     # 49 leap years up to 2096
MONTHS = (31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)


def _number(key: str, tweak: str, turn: int, value: Column) -> Column:
    """A keyed number below 2**60 for ``value``."""
    mixed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tweak), F.lit(str(turn)),
                               value.cast("string")), 256)
    return F.conv(F.substring(mixed, 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, a: Column | int, b: Column | int, key: str,
            tweak: str) -> Column:
    """Struct (l, r): a keyed permutation of the pairs with 0 <= l < a and 0 <= r < b."""
    a, b = (F.lit(x).cast("bigint") if isinstance(x, int) else x for x in (a, b))
    pair = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    for turn in range(TURNS):
        pair = bind(pair, lambda p, t=turn: F.struct(
            F.pmod(p["l"] + _number(key, tweak, 2 * t, p["r"]), a).alias("l"), p["r"].alias("r")))
        pair = bind(pair, lambda p, t=turn: F.struct(
            p["l"].alias("l"),
            F.pmod(p["r"] + _number(key, tweak, 2 * t + 1, p["l"]), b).alias("r")))
    return pair


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _padded(number: Column, size: Column | int) -> Column:
    size = F.lit(size) if isinstance(size, int) else size
    return F.lpad(number.cast("string"), size, "0")


def refill(value: Column, digits: Column, first: int = 0) -> Column:
    """``value`` with its digits from number ``first`` on replaced by ``digits`` in order."""
    parts = F.split(value, "")

    def at(i: Column) -> Column:
        return F.char_length(_digits(F.substr(value, F.lit(1), i + 1)))

    return F.array_join(F.transform(parts, lambda c, i: F.when(
        c.between("0", "9") & (c != "") & (at(i) > first),
        F.substr(digits, at(i) - first, F.lit(1))).otherwise(c)), "")


def permuted_digits(digits: Column, key: str, tweak: str) -> Column:
    """A permutation of all digit strings of the same length, 2 to 36 digits."""
    size = F.char_length(digits)
    half = F.floor(size / 2).cast("int")
    ten = lambda n: F.pow(F.lit(10.0), n).cast("bigint")
    pair = feistel(F.substr(digits, F.lit(1), half).cast("bigint"),
                   F.substr(digits, half + 1, size - half).cast("bigint"),
                   ten(half), ten(size - half), key, tweak)
    return bind(pair, lambda p: F.concat(_padded(p["l"], half), _padded(p["r"], size - half)))


def luhn_sum(digits: Column) -> Column:
    """Sum with every second digit doubled, from the right, beginning with the last but one."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") >= 5, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(places, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))


def _email(value: Column, key: str) -> Column:
    """Letters and digits of the name before the @, as two halves that shift each other."""
    name, host = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)

    def shifted(part: Column, by: Column, turn: int) -> Column:
        stream = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lit(str(turn)), by), 512)

        def sign(c: Column, i: Column) -> Column:
            step = F.conv(F.substr(stream, i * 3 % 126 + 1, F.lit(3)), 16, 10).cast("int")
            move = lambda s: F.substr(F.lit(s), F.pmod(
                F.instr(F.lit(s), c) - 1 + step, F.lit(len(s))) + 1, F.lit(1))
            return F.when(c == "", c).when(c.between("a", "z"), move(LETTERS)) \
                .when(c.between("A", "Z"), move(LETTERS.upper())) \
                .when(c.between("0", "9"), move(DIGITS)).otherwise(c)
        return F.array_join(F.transform(F.split(part, ""), sign), "")

    half = F.floor(F.char_length(name) / 2).cast("int")
    pair = F.struct(F.substr(name, F.lit(1), half).alias("l"),
                    F.substr(name, half + 1, F.char_length(name)).alias("r"))
    for turn in range(TURNS):
        pair = bind(pair, lambda p, t=turn: F.struct(
            shifted(p["l"], p["r"], 2 * t).alias("l"), p["r"].alias("r")))
        pair = bind(pair, lambda p, t=turn: F.struct(
            p["l"].alias("l"), shifted(p["r"], p["l"], 2 * t + 1).alias("r")))
    return bind(pair, lambda p: F.concat(p["l"], p["r"], F.lit("@"), host))


def _ip(value: Column, key: str) -> Column:
    o = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    pair = bind(o, lambda o: feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip"))
    return bind(pair, lambda p: F.concat_ws(".", *[
        F.floor(p[s] / 256) if high else p[s] % 256 for s in ("l", "r") for high in (1, 0)]))


def _phone(value: Column, key: str) -> Column:
    """Area and exchange stay between 200 and 999."""
    def new(d: Column) -> Column:
        n = F.substr(d, F.char_length(d) - 9, F.lit(10))
        pair = feistel(F.substr(n, F.lit(1), F.lit(3)).cast("bigint") - 200,
                       F.substr(n, F.lit(4), F.lit(7)).cast("bigint") - 2_000_000,
                       800, 8_000_000, key, "phone")
        return bind(pair, lambda p: F.concat((p["l"] + 200).cast("string"),
                                             (p["r"] + 2_000_000).cast("string")))
    digits = _digits(value)
    ten = bind(digits, new)
    return F.when(F.char_length(digits) == 11, refill(value, ten, 1)).otherwise(refill(value, ten))


def _ssn(value: Column, key: str) -> Column:
    d = _digits(value)
    area = F.substr(d, F.lit(1), F.lit(3)).cast("bigint")
    area = F.when(area > 666, area - 2).otherwise(area - 1)
    rest = (F.substr(d, F.lit(4), F.lit(2)).cast("bigint") - 1) * 9999 \
        + F.substr(d, F.lit(6), F.lit(4)).cast("bigint") - 1
    pair = feistel(area, rest, 898, 99 * 9999, key, "ssn")
    return bind(pair, lambda p: F.concat_ws(
        "-", _padded(F.when(p["l"] >= 665, p["l"] + 2).otherwise(p["l"] + 1), 3),
        _padded(F.floor(p["r"] / 9999) + 1, 2), _padded(p["r"] % 9999 + 1, 4)))


def _card(value: Column, key: str) -> Column:
    """The first digit stays, the last is the new check digit."""
    def new(d: Column) -> Column:
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permuted_digits(
            F.substr(d, F.lit(2), F.char_length(d) - 2), key, "card"))
        return bind(body, lambda b: F.concat(
            b, F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return refill(value, bind(_digits(value), new))


def _foreign(value: Column, key: str) -> Column:
    """The first two digits, which hold the country, stay."""
    d = _digits(value)
    return refill(value, permuted_digits(F.substr(d, F.lit(3), F.char_length(d)), key, "foreign"), 2)


def iban_rest(value: Column) -> Column:
    """Remainder by 97 of the rearranged number: 1 for a valid one."""
    v = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(v, F.lit(5), F.char_length(v)), F.substr(v, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda s, c: F.when(c == "", s).when(
        c.between("0", "9"), (s * 10 + c.cast("int")) % 97).otherwise(
        (s * 100 + F.ascii(c) - 55) % 97))


def _iban(value: Column, key: str) -> Column:
    """Digits after the check digits are permuted, letters stay; the check is made anew."""
    d = _digits(value)
    size = F.char_length(d) - 2
    body = F.when(size >= 2, refill(value, F.concat(F.lit("00"), permuted_digits(
        F.substr(d, F.lit(3), size), key, "iban")))).otherwise(value)
    return F.when(size >= 2, bind(body, lambda b: F.concat(
        F.substr(b, F.lit(1), F.lit(2)), _padded(98 - iban_rest(b), 2),
        F.substr(b, F.lit(5), F.char_length(b))))).otherwise(value)


def _day(value: Column) -> Column:
    """The day of an ISO, d.m.y or m/d/y date; null for a date that does not exist."""
    parts = F.split(value, "[./-]")
    year, month, day = F.get(parts, F.lit(2)), F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    dotted = F.concat_ws("-", year, _padded(day, 2), _padded(month, 2))
    slashed = F.concat_ws("-", year, _padded(month, 2), _padded(day, 2))
    text = F.when(value.contains("-"), value).when(value.contains("."), dotted).otherwise(slashed)
    return F.when(value.contains("/"), F.coalesce(F.try_to_date(text, "yyyy-MM-dd"),
                                                  F.try_to_date(dotted, "yyyy-MM-dd"))) \
        .otherwise(F.try_to_date(text, "yyyy-MM-dd"))


def _days_before(months: int, first: int, last: int) -> list[int]:
    """How many days of a common year lie before each month, counting days first to last only."""
    before = [0]
    for size in MONTHS[:months]:
        before.append(before[-1] + max(0, min(last, size) - first + 1))
    return before


def _date(value: Column, key: str) -> Column:
    """Another date in the same writing: order, signs between and digits of day and month stay.

    The dates of one writing are a domain of their own: months and days of one digit or two, and
    with slashes those that only read as day/month/year apart from those that read as
    month/day/year. A domain is permuted as years times days of a common year, and its 29ths of
    February among themselves, so two values never get one pseudonym.
    """
    part = lambda i: F.get(F.split(value, "[./-]"), F.lit(i))
    iso, dotted = value.contains("-"), value.contains(".")
    late = value.contains("/") & (part(0).try_cast("int") > 12)
    first = F.when(iso, F.lit("y")).when(dotted | late, F.lit("d")).otherwise(F.lit("m"))
    fields = F.struct(F.when(iso, part(0)).otherwise(part(2)).alias("y"), F.when(iso, part(1)).when(
        first == "d", part(1)).otherwise(part(0)).alias("m"), F.when(iso, part(2)).when(
        first == "d", part(0)).otherwise(part(1)).alias("d"))
    wide = F.char_length

    def choose(f: Column, make) -> Column:
        """``make(months, first day, last day)`` of the domain that the value is in."""
        out = F
        for months, one_month in ((9, True), (12, False)):
            for low, high, holds in ((13, 31, late), (1, 9, wide(f["d"]) == 1), (1, 31, F.lit(True))):
                out = out.when(((wide(f["m"]) == 1) == F.lit(one_month)) & holds, make(months, low, high))
        return out

    def new(f: Column) -> Column:
        year, month, day = (f[c].cast("int") for c in ("y", "m", "d"))
        table = choose(f, lambda m, lo, hi: F.array(*map(F.lit, _days_before(m, lo, hi))))
        low = F.when(late, F.lit(13)).otherwise(F.lit(1))
        sized = bind(table, lambda t: F.struct(t.alias("t"), F.element_at(t, -1).alias("n"),
                                               (F.get(t, month - 1) + day - low).alias("i")))
        common = bind(sized, lambda s: bind(
            feistel(year - FIRST_YEAR, s["i"], YEARS, s["n"].cast("bigint"), key, "date"),
            lambda p: bind(F.size(F.filter(s["t"], lambda x: x <= p["r"])), lambda m: F.struct(
                (p["l"] + FIRST_YEAR).alias("y"), m.alias("m"),
                (p["r"] - F.get(s["t"], m - 1) + low).alias("d")))))
        leap = bind((year - FIRST_LEAP) / 4, lambda i: bind(
            feistel(F.floor(i / 7), F.pmod(i.cast("bigint"), F.lit(7)), 7, 7, key, "leap"), lambda p: F.struct(
                (p["l"] * 28 + p["r"] * 4 + FIRST_LEAP).alias("y"), F.lit(2).alias("m"),
                F.lit(29).cast("bigint").alias("d"))))
        found = F.when((month == 2) & (day == 29), leap).otherwise(common)
        return bind(found, lambda n: bind(F.struct(
            n["y"].cast("string").alias("y"), _padded(n["m"], wide(f["m"])).alias("m"),
            _padded(n["d"], wide(f["d"])).alias("d")), lambda w: F.when(iso, F.concat_ws(
                "-", w["y"], w["m"], w["d"])).when(dotted, F.concat_ws(".", w["d"], w["m"], w["y"])).when(
                late, F.concat_ws("/", w["d"], w["m"], w["y"])).otherwise(
                F.concat_ws("/", w["m"], w["d"], w["y"]))))

    return bind(fields, new)


MAKERS = {"email": _email, "date": _date, "ssn": _ssn, "phone": _phone, "foreign": _foreign,
          "ip": _ip, "card": _card, "iban": _iban}


def kind_of(value: Column) -> Column:
    """The kind of a matched value, null if it is not valid."""
    size = F.char_length(_digits(value))
    valid = {
        "date": _day(value).between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")),
        "foreign": size.between(8, 15),
        "card": size.between(13, 19) & (F.pmod(luhn_sum(_digits(value)), F.lit(10)) == 0),
        "iban": iban_rest(value) == 1}
    found = reduce(lambda w, k: w.when(value.rlike(f"^(?:{FORMS[k]})$"), F.lit(k)), FORMS, F)
    return bind(found, lambda k: reduce(
        lambda w, x: w.when((k == x) & ~F.coalesce(valid[x], F.lit(False)), F.lit(None)),
        valid, F).otherwise(k))


def pseudonymise(df: DataFrame, key: str, text: str = "text") -> tuple[DataFrame, str]:
    """``df`` with personal data in ``text`` replaced, and an array column (kind, old, new).

    ``key`` is the secret of the permutation. Texts without digit or @ are left alone after
    one search. A null text stays null, rows never meet, and what is not valid (a card
    number with a wrong check digit, a date that does not exist) stays as it is. Local part
    of an e-mail address: letters and digits permuted, the host stays. Returns the frame and
    the name of the array column, which holds the changes in the order of the text.
    """
    found = fresh(df, "pii")
    value = F.col(text)
    may = value.rlike("[0-9@]")
    spans = F.transform(F.regexp_extract_all(value, F.lit(ANY), F.lit(0)), lambda v: F.struct(
        kind_of(v).alias("kind"), v.alias("old")))

    def renew(s: Column) -> Column:
        new = reduce(lambda w, k: w.when(s["kind"] == k, MAKERS[k](s["old"], key)), MAKERS, F)
        return F.struct(s["kind"].alias("kind"), s["old"].alias("old"),
                        new.otherwise(s["old"]).alias("new"))

    none = F.array().cast("array<struct<kind:string,old:string,new:string>>")
    out = df.withColumn(found, F.when(may, F.transform(spans, renew)).otherwise(none))
    gaps = F.split(value, ANY, -1)
    joined = F.array_join(F.transform(gaps, lambda g, i: F.concat(
        g, F.coalesce(F.get(F.col(found), i)["new"], F.lit("")))), "")
    return out.withColumn(text, F.when(F.size(found) > 0, joined).otherwise(value)) \
        .withColumn(found, F.filter(found, lambda s: s["kind"].isNotNull())), found
