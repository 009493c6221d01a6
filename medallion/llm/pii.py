r"""Format-preserving pseudonyms for personal data by keyed Feistel networks (native).

A match is turned into symbols with a base each (decimal digit 10, letter 26,
hexadecimal digit 16, IP octet 256, a day of the calendar as the two digits of its
number among like days of 400 years).  Eight Feistel rounds add a keyed hash of one half
to the other half, symbol by symbol and modulo the base.  Each round can be
undone, so different values stay different and equal values, however they are
punctuated, get the same pseudonym in every document.

Only validated values change: cards and IBANs by their check digits (which are
computed anew), octets up to 255, dates that the calendar has, IPv6 addresses of
eight groups; emails, phone numbers, social security numbers, long hexadecimal
secrets and keys with a known prefix (which stays) by their form.

A date keeps whether its day and its month are below ten, so that every notation of it,
with zeros or without, keeps its length and all of them get the same date; 29 February
moves among leap years.  An IPv6 address is written out in eight groups, whatever was
left out.  A national phone number keeps its leading zero.  A secret of more than ``BLOCK`` digits is
permuted block by block.

Defined cases
* null text: null, no matches; empty text: unchanged; a text without a match is
  returned as it is; texts are searched whole;
* null ids, repeated rows, ties and further columns: each row is treated alone,
  its other columns are kept; empty table: empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_KEY = "set-your-own-secret"
ROUNDS = 8

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: Lengths of IBANs by country (fixed list of the registry).
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
#: Printed in groups of four; the country's length says where it ends, so that no word after it is taken in.
_PRINTED = "|".join(
    rf"(?:{c.replace(' ', '|')})\d{{2}}(?:[ -]?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"[ -]?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, c in _IBAN_LENGTHS.items())
#: Country codes of phone numbers (fixed list of the ITU): one or two digits, all others have three.
_DIAL = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
#: Forms, in the order in which they are tried at each position (fixed formats).
_PREFIX = r"AKIA|ASIA|sk-|gh[pousr]_|xox[abprs]-|AIza"
FORMS = {
    "key": r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|sk-[A-Za-z0-9_-]{20,200}|gh[pousr]_[A-Za-z0-9]{36,251}"
           r"|xox[abprs]-[A-Za-z0-9-]{10,200}|AIza[0-9A-Za-z_-]{35})(?![A-Za-z0-9])",
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:{_PRINTED}|[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}})(?![A-Za-z0-9])",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?![\w]|\.\d)",
    "ipv6": r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4}:|:)(?:[0-9A-Fa-f]{0,4}:){1,6}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)",
    "date": r"(?<![\w/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})"
            r"(?!(?![Tt]\d{2})\w|[/.-]\d)",  # a time may follow after T
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w]|-\d)",
    "card": r"(?<![\w])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w])",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}"
             r"|\d{3}[ .-]\d{3}[ .-]\d{4}|(?<![.-])0\d{1,4}[ .-]\d{3,4}[ .-]\d{3,4}(?![.-]\d))(?![\w])",
}
ANY = "|".join(f"(?:{p})" for p in FORMS.values())
#: Every match holds one of these; cheap to test first.
MAYBE = rf"@|{_PREFIX}|:[0-9A-Fa-f]{{0,4}}:|" r"\d[\d .()/-]{3}|[0-9A-Fa-f]{32}|[A-Z]{2}\d{2}(?:[A-Z0-9]{11}|[ -][A-Z0-9]{4})"


def _let(value: Column, body) -> Column:
    """``body(value)`` with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(symbols: Column, bases: Column, kind: Column, key: str) -> Column:
    """Keyed permutation of an array of symbols; symbol i stays below bases[i]."""
    n = F.size(symbols)
    half = F.floor(n / 2).cast("int")

    def one(state: Column, r: Column) -> Column:
        first = (r % 2) == 0
        low = F.when(first, 0).otherwise(half)  # the part that changes is [low, low + length)
        length = F.when(first, half).otherwise(n - half)
        other = F.when(first, F.slice(state, half + 1, n - half)).otherwise(F.slice(state, F.lit(1), half))
        text = F.concat_ws(",", F.lit(key), kind, n.cast("string"), r.cast("string"),
                           F.array_join(other.cast("array<string>"), ","))
        pieces = F.sequence(F.lit(0), F.greatest(F.floor((length - 1) / 16).cast("int"), F.lit(0)))
        digest = F.array_join(F.transform(pieces, lambda c: F.sha2(
            F.concat_ws(",", text, c.cast("string")), 512)), "")

        def turned(d: Column) -> Column:
            def symbol(x: Column, i: Column) -> Column:
                add = F.conv(F.substr(d, (i - low) * 8 + 1, F.lit(8)), 16, 10).cast("long")
                return F.when((i >= low) & (i < low + length),
                              ((x + add) % F.get(bases, i)).cast("int")).otherwise(x)
            return F.transform(state, symbol)
        return _let(digest, turned)

    return F.when(n < 2, symbols).otherwise(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), symbols, one))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _base(c: Column, hexed: bool = False) -> Column:
    """Base of a character: 0 if it stays as it is."""
    if hexed:
        return F.lit(16)
    return F.when(c.rlike("[0-9]"), 10).when(c.rlike("[a-z]"), 26).when(c.rlike("[A-Z]"), 26).otherwise(0)


def _value(c: Column, hexed: bool = False) -> Column:
    if hexed:
        return F.conv(c, 16, 10).cast("int")
    return F.when(c.rlike("[0-9]"), c.cast("int")).when(c.rlike("[a-z]"), F.ascii(c) - 97).otherwise(F.ascii(c) - 65)


def _shown(c: Column, v: Column, hexed: bool = False) -> Column:
    """The new symbol in the class of character c."""
    if hexed:
        return F.lower(F.hex(v))
    return (F.when(c.rlike("[0-9]"), v.cast("string")).when(c.rlike("[a-z]"), F.char(v + 97))
            .otherwise(F.char(v + 65)))


def _permuted(s: Column, kind: Column, key: str, hexed: bool = False) -> Column:
    """The string with its digits and letters permuted within their classes, other characters in place."""
    def with_chars(chars: Column) -> Column:
        moving = F.filter(chars, lambda c: _base(c, hexed) > 0)

        def with_moving(m: Column) -> Column:
            new = feistel(F.transform(m, lambda c: _value(c, hexed)), F.transform(m, lambda c: _base(c, hexed)),
                          kind, key)

            def with_new(v: Column) -> Column:
                shown = F.transform(m, lambda c, i: _shown(c, F.get(v, i), hexed))

                def put(shown_: Column) -> Column:
                    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("k"))
                    return F.aggregate(chars, start, lambda a, c: F.when(
                        _base(c, hexed) > 0,
                        F.struct(F.concat(a["s"], F.get(shown_, a["k"])).alias("s"), (a["k"] + 1).alias("k"))).otherwise(
                        F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))))["s"]
                return _let(shown, put)
            return _let(new, with_new)
        return _let(moving, with_moving)
    return _let(_chars(s), with_chars)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def _luhn_sum(d: Column, shift: int) -> Column:
    """Luhn sum of a digit string; every second digit from the right counts double, from the last one if shift is 1."""
    return F.aggregate(F.transform(_chars(F.reverse(d)), lambda c, i: F.when(
        (i + shift) % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)


def luhn_ok(s: Column) -> Column:
    return (_luhn_sum(_digits(s), 0) % 10) == 0


def _laid_out(pattern: Column, digits: Column, moving: str = "[0-9]") -> Column:
    """``digits`` put in place of the digits (or ``moving`` characters) of ``pattern``, in order."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    return F.aggregate(_chars(pattern), start, lambda a, c: F.when(
        c.rlike(moving), F.struct(F.concat(a["s"], F.substr(digits, a["k"], F.lit(1))).alias("s"), (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))))["s"]


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    payload = _permuted(F.substr(d, F.lit(1), F.length(d) - 1), F.lit("card"), key)
    return _let(payload, lambda p: _laid_out(
        m, F.concat(p, F.pmod(-_luhn_sum(p, 1), F.lit(10)).cast("string"))))


def _mod97(s: Column) -> Column:
    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int")
    return F.aggregate(_chars(s), F.lit(0), step)


def _bare(m: Column) -> Column:
    return F.regexp_replace(m, "[ -]", "")


def iban_ok(m: Column) -> Column:
    return _let(_bare(m), lambda b: _mod97(F.concat(F.substr(b, F.lit(5)), F.substr(b, F.lit(1), F.lit(4)))) == 1)


def _iban(m: Column, key: str) -> Column:
    country = F.substr(m, F.lit(1), F.lit(2))
    return _let(_permuted(F.substr(_bare(m), F.lit(5)), F.lit("iban"), key), lambda p: _laid_out(m, F.concat(
        country, F.lpad((98 - _mod97(F.concat(p, country, F.lit("00")))).cast("string"), 2, "0"), p), "[0-9A-Z]"))


def _ip(m: Column, key: str) -> Column:
    octets = F.split(m, r"\.").cast("array<int>")
    return F.array_join(feistel(octets, F.array(*[F.lit(256)] * 4), F.lit("ip"), key).cast("array<string>"), ".")


def _day(m: Column) -> Column:
    """The date of a match, null if the calendar has none; day before month, else month before day."""
    p = F.split(m, r"[/.-]")
    iso = F.get(p, F.lit(0)).rlike(r"^\d{4}$")

    def made(y: int, mo: int, d: int) -> Column:
        return F.to_date(F.try_to_timestamp(F.concat_ws("-", F.get(p, F.lit(y)), F.lpad(F.get(p, F.lit(mo)), 2, "0"),
                                                        F.lpad(F.get(p, F.lit(d)), 2, "0")), F.lit("yyyy-MM-dd")))
    return F.when(iso, made(0, 1, 2)).otherwise(F.coalesce(made(2, 1, 0), made(2, 0, 1)))


# Days of 400 years in four classes: day below ten or not, month below ten or not.  A class has the same days in
# every year but for 29 February, which is a class of its own: (days a year, the two bases of their numbers).
_CLASSES = {(True, True): (81, 180, 180), (True, False): (27, 100, 108), (False, True): (192, 240, 320),
            (False, False): (65, 130, 200)}
_LATE = {True: [0, 22, 41, 63, 84, 106, 127, 149, 171], False: [0, 22, 43]}  # days from the 10th on before each month
_LEAP = [y for y in range(0, 400, 4) if y % 100 or y == 0]


def _date(m: Column, key: str) -> Column:
    """The day moved within its class of the same 400 years; the layout (order, separators, zeros, length) stays."""
    p = F.split(m, r"[/.-]")
    sep = F.regexp_extract(m, r"([/.-])", 1)

    def moved(day: Column) -> Column:
        y, mo, d = F.year(day), F.month(day), F.dayofmonth(day)
        at, cycle = F.pmod(y - 1600, F.lit(400)), F.floor((y - 1600) / 400).cast("int")
        small_d, small_m = d < 10, mo < 10

        def by_class(values: dict) -> Column:
            return (F.when(small_d & small_m, values[True, True]).when(small_d, values[True, False])
                    .when(small_m, values[False, True]).otherwise(values[False, False]))
        year_days, base1, base2 = (by_class({k: F.lit(v[i]) for k, v in _CLASSES.items()}) for i in range(3))
        first = F.when(small_m, 1).otherwise(10)
        late = F.when(small_m, F.array(*map(F.lit, _LATE[True]))).otherwise(F.array(*map(F.lit, _LATE[False])))
        number = at * year_days + F.when(small_d, (mo - first) * 9 + d - 1).otherwise(F.get(late, mo - first) + d - 10)
        new = feistel(F.array(F.floor(number / base2).cast("int"), (number % base2).cast("int")), F.array(base1, base2),
                      F.lit("date"), key)

        def shown(year: Column, month: Column, day_: Column) -> Column:
            y_ = F.lpad((1600 + cycle * 400 + year).cast("string"), 4, "0")
            def part(value: Column, i: int) -> Column:
                return F.lpad(value.cast("string"), F.length(F.get(p, F.lit(i))), F.lit("0"))
            return (F.when(F.get(p, F.lit(0)).rlike(r"^\d{4}$"), F.concat(y_, sep, part(month, 1), sep, part(day_, 2)))
                    .when(F.get(p, F.lit(1)).cast("int") <= 12, F.concat(part(day_, 0), sep, part(month, 1), sep, y_))
                    .otherwise(F.concat(part(month, 0), sep, part(day_, 1), sep, y_)))

        def ordinary(v: Column) -> Column:
            n = F.get(v, F.lit(0)) * base2 + F.get(v, F.lit(1))
            i, year = (n % year_days).cast("int"), F.floor(n / year_days).cast("int")
            k = F.size(F.filter(late, lambda x: x <= i)) - 1
            return shown(year, first + F.when(small_d, F.floor(i / 9).cast("int")).otherwise(k),
                         F.when(small_d, i % 9 + 1).otherwise(10 + i - F.get(late, k)))

        leap = F.array(*map(F.lit, _LEAP))
        step = F.conv(F.substring(F.sha2(F.concat_ws(",", F.lit(key), F.lit("leap")), 256), 1, 8), 16, 10).cast("long")
        turned = F.get(leap, ((F.array_position(leap, at) - 1 + step) % len(_LEAP)).cast("int"))
        return F.when((mo == 2) & (d == 29), shown(turned, mo, d)).otherwise(_let(new, ordinary))
    return _let(_day(m), moved)


def _email(m: Column, key: str) -> Column:
    """All but the last label of the domain is permuted."""
    cut = F.length(m) - F.length(F.substring_index(m, ".", -1))
    return F.concat(_permuted(F.lower(F.substr(m, F.lit(1), cut)), F.lit("email"), key), F.substr(m, cut + 1))


def _phone(m: Column, key: str) -> Column:
    """The country code, or the zero of a national number, stays; the code is read from the bare digits, so that every punctuation gives the same."""
    d = _digits(m)
    code = (F.when(F.startswith(m, F.lit("+")), F.regexp_extract(d, f"^({_DIAL})", 1))
            .when(F.startswith(m, F.lit("0")), "0").otherwise(""))
    return _let(F.concat(code, _permuted(F.substr(d, F.length(code) + 1), F.lit("phone"), key)),
                lambda new: _laid_out(m, new))


BLOCK = 128  # digits of a secret that are permuted together


def _secret(m: Column, key: str) -> Column:
    low = F.lower(m)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.length(m) - 1) / BLOCK).cast("int")), lambda i: _permuted(
        F.substr(low, i * BLOCK + 1, F.lit(BLOCK)), F.concat(F.lit("secret"), F.when(i > 0, i.cast("string")).otherwise("")),
        key, hexed=True))
    return _let(F.array_join(blocks, ""), lambda new: F.when(m == F.upper(m), F.upper(new)).otherwise(new))


def _key(m: Column, key: str) -> Column:
    """The prefix, which names the service, stays."""
    prefix = F.regexp_extract(m, f"^({_PREFIX})", 1)
    return F.concat(prefix, _permuted(F.substr(m, F.length(prefix) + 1), F.lit("key"), key))


def _groups(m: Column) -> Column:
    """The groups of an IPv6 address that are written."""
    return F.filter(F.split(m, ":"), lambda g: g != "")


def ipv6_ok(m: Column) -> Column:
    n = F.size(_groups(m))
    gap = F.contains(m, F.lit("::"))
    one = F.size(F.split(m, "::", -1)) == 2
    whole = ~m.rlike("^:[^:]|[^:]:$")
    return whole & m.rlike("[0-9]") & F.when(gap, one & (n >= 2) & (n <= 7)).otherwise(n == 8)


def _ipv6(m: Column, key: str) -> Column:
    def filled(part: Column) -> Column:
        return F.array_join(F.transform(_groups(part), lambda g: F.lpad(g, 4, "0")), "")
    left, right = (filled(F.get(F.split(m, "::", -1), F.lit(i))) for i in (0, 1))
    right = F.coalesce(right, F.lit(""))
    bare = F.lower(F.concat(F.rpad(left, F.lit(32) - F.length(right), F.lit("0")), right))
    new = F.regexp_replace(_permuted(bare, F.lit("ipv6"), key, hexed=True), "(.{4})(?=.)", "$1:")
    return _let(new, lambda n: F.when((m == F.upper(m)) & (m != F.lower(m)), F.upper(n)).otherwise(n))


def kind_of(m: Column) -> Column:
    """Kind of a match, null if its value is not valid."""
    def is_(kind: str) -> Column:
        return m.rlike(f"^(?:{FORMS[kind]})$")
    return (F.when(is_("key"), "key").when(F.contains(m, F.lit("@")), "email").when(is_("secret"), "secret")
            .when(is_("iban") & iban_ok(m), "iban").when(is_("ip"), "ip").when(is_("ipv6"), F.when(ipv6_ok(m), "ipv6"))
            .when(is_("date") & _day(m).isNotNull(), "date").when(is_("ssn"), "ssn")
            .when(is_("card"), F.when(luhn_ok(m), "card")).when(is_("phone"), "phone"))


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    make = {"key": _key, "email": _email, "secret": _secret, "ipv6": _ipv6, "iban": _iban, "ip": _ip, "date": _date, "card": _card, "phone": _phone}
    out = F.when(kind == "ssn", _permuted(m, F.lit("ssn"), key))
    for k, f in make.items():
        out = out.when(kind == k, f(m, key))
    return out.otherwise(m)


def _free(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str = DEFAULT_KEY,
                 kinds_col: str | None = None) -> DataFrame:
    """``docs`` with the personal data of ``text_col`` replaced; all columns and rows kept.

    ``kinds_col``: name of a further column (array of the kinds replaced, in
    order; null text: empty), replacing a column of that name.
    """
    t = F.col(f"`{text_col}`")
    found_col, parts_col = _free(docs, "_found"), _free(docs, "_parts")
    hit = t.rlike(MAYBE)
    none = F.array().cast("array<struct<m:string,k:string>>")
    found = F.transform(F.regexp_extract_all(t, F.lit(ANY), F.lit(0)),
                        lambda m: F.struct(m.alias("m"), kind_of(m).alias("k")))
    d = docs.withColumn(found_col, F.when(hit, found).otherwise(none))
    parts = F.when(F.size(found_col) > 0, F.split(t, ANY, -1))
    d = d.withColumn(parts_col, parts)
    new = F.array_join(F.zip_with(F.col(parts_col), F.col(found_col), lambda p, f: F.concat(p, F.when(
        f.isNull(), "").otherwise(pseudonym(f["m"], f["k"], key)))), "")
    changed = F.exists(F.col(found_col), lambda f: f["k"].isNotNull())
    out = [F.when(changed, new).otherwise(t).alias(c) if c == text_col else F.col(f"`{c}`")
           for c in docs.columns if c != kinds_col]
    if kinds_col:
        out.append(F.filter(F.transform(F.col(found_col), lambda f: f["k"]), lambda k: k.isNotNull()).alias(kinds_col))
    return d.select(*out)
