"""PII: format-preserving Feistel pseudonyms.

Cards, IBANs, social security numbers, phone numbers, IPv4 addresses and dates
are validated and then permuted, keyed, inside their own format by a Feistel
network over two mixed-radix halves: the pseudonym is valid where the original
was, different values stay different, and equal values stay equal in all
documents.  Separators stay where they are.  E-mail addresses get keyed names.

DataFrame functions only; the key is a parameter.  Defined cases: null text
stays null; empty text stays empty; matches do not overlap (the leftmost, then
the kind listed first); an IBAN or card ends where its check sum holds, so text
or digits beside it do not hide it; digits that no rule validates stay as they
are; every row is treated on its own; a very long text is treated whole (its valid
numbers become part of its pattern, so time grows with their number times the length);
other columns stay (one named ``pii`` is replaced); an empty table gives an empty result.
Letters of an IBAN's bank code stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Kind and pattern; the order decides between matches at one place.  IBANs and
#: cards are matched by ``valid_numbers``, between e-mail addresses and the rest.
KINDS: tuple[tuple[str, str], ...] = (
    ("email", r"(?<!-)[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    ("ssn", r"(?<!-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    ("ip", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"),
    ("date", r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[/.][0-9]{1,2}[/.][0-9]{4})(?![0-9A-Za-z])"),
    ("phone", r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
              r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])"),
)
_LEFT = r"(?<![A-Za-z0-9_+@.])"
_END = r"(?![0-9A-Za-z])"
_HEAD = f"{_LEFT}(?:{KINDS[0][1]}|"
_TAIL = "|".join(p for _, p in KINDS[1:]) + ")"
PATTERN = _HEAD + _TAIL
#: The longest text from one place that may be an IBAN; its prefixes are tried.
IBAN = r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?" + _END
#: Lengths of the IBAN registry by country.
IBAN_LENGTHS = {code: n for n, codes in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}
#: One to five groups of four digits or more (the last may be shorter), from
#: every place; Luhn decides.
CARD_GROUPS = (r"[0-9]{13,19}" + _END, *(
    rf"[0-9]{{4,15}}(?:[ -][0-9]{{4,15}}){{{n}}}[ -][0-9]{{1,15}}" + _END for n in range(4)))
#: A whole run of 13-19 digits in any grouping, unless it holds a date, a social
#: security number or a phone number.
CARD_RUN = r"(?<![0-9][ -])[2-6](?:[ -]?[0-9]){12,18}(?![ -]?[0-9]|[A-Za-z])"
_OTHER_RUN = r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{3}[ -][0-9]{2,3}[ -][0-9]{4})(?![0-9])"


def _round(key: str, tweak: Column, i: Column, other: Column, size: Column) -> Column:
    code = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), other.cast("string")), 256)
    return F.pmod(F.conv(F.substring(code, 1, 15), 16, 10).cast("long"), size)


def feistel(a: Column, b: Column, size_a: Column, size_b: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the pairs (a < size_a, b < size_b): the halves
    are shifted in turn by a keyed function of the other one."""
    state = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 0, F.struct(
            F.pmod(s.a + _round(key, tweak, i, s.b, size_a), size_a).alias("a"), s.b.alias("b"))).otherwise(
            F.struct(s.a.alias("a"), F.pmod(s.b + _round(key, tweak, i, s.a, size_b), size_b).alias("b")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), state, step)


def _pow10(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """Digits of one length onto digits of that length (30 at most, as many as any
    account number has; of more, the last 30 are permuted)."""
    n = F.least(F.char_length(digits), F.lit(30))
    head = F.substring(digits, F.lit(1), F.char_length(digits) - n)
    body = F.substring(digits, F.char_length(digits) - n + 1, n)
    u = F.floor(n / 2).cast("int")
    v = n - u
    a = F.coalesce(F.substring(body, F.lit(1), u).try_cast("long"), F.lit(0))
    b = F.coalesce(F.substring(body, u + 1, v).try_cast("long"), F.lit(0))
    f = feistel(a, b, _pow10(u), _pow10(v), key, F.concat_ws("|", F.lit(kind), n.cast("string"), head))
    return F.when(n == 0, digits).otherwise(F.concat(
        head, F.when(u > 0, F.lpad(f["a"].cast("string"), u, F.lit("0"))).otherwise(F.lit("")),
        F.lpad(f["b"].cast("string"), v, F.lit("0"))))


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def fill(template: Column, digits: Column, skip: int = 0) -> Column:
    """``template`` with its digits, after the first ``skip``, replaced in turn."""
    state = F.struct(F.lit(0).alias("k"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        return F.struct(
            (s.k + F.when(digit, 1).otherwise(0)).alias("k"),
            F.concat(s.out, F.when(digit & (s.k >= skip), F.substring(digits, s.k - skip + 1, F.lit(1))).otherwise(c))
            .alias("out"))

    return F.aggregate(F.split(template, ""), state, step)["out"]


def luhn_sum(digits: Column, shift: int = 0) -> Column:
    """Luhn sum; ``shift`` 1 counts as if a check digit were to follow."""
    doubled = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(
        (i + shift) % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))
        .otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def _card_valid(value: Column) -> Column:
    d = _only_digits(value)
    return F.char_length(d).between(13, 19) & (F.pmod(luhn_sum(d), F.lit(10)) == 0)


def _card(value: Column, key: str) -> Column:
    d = _only_digits(value)
    first = F.substring(d, 1, 1)
    body = F.concat(first, permute_digits(F.substring(d, F.lit(2), F.char_length(d) - 2), key, "card"))
    check = F.pmod(F.lit(10) - F.pmod(luhn_sum(body, 1), F.lit(10)), F.lit(10)).cast("string")
    return F.when(_card_valid(value), fill(value, F.concat(body, check)))


def _mod97(text: Column) -> Column:
    """Of digits and capital letters (A = 10 ... Z = 35)."""
    def step(s: Column, c: Column) -> Column:
        x = F.when(c.rlike("^[0-9]$"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
        return F.pmod(F.when(x > 9, s * 100).otherwise(s * 10) + x, F.lit(97))

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban_valid(value: Column) -> Column:
    flat = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(flat, F.lit(5), F.lit(100)), F.substring(flat, 1, 4))
    return F.char_length(flat).between(15, 34) & (_mod97(turned) == 1)


def _iban(value: Column, key: str) -> Column:
    flat = F.regexp_replace(value, " ", "")
    country, rest = F.substring(flat, 1, 2), F.substring(flat, F.lit(5), F.lit(100))
    digits = permute_digits(_only_digits(rest), key, "iban")
    new = fill(rest, digits)
    check = F.lpad((F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(_iban_valid(value), fill(value, F.concat(check, digits)))


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.substring(value, a, n).try_cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    # areas 1-899 without 666 are numbered 0-897
    f = feistel(F.when(area > 666, area - 2).otherwise(area - 1), (group - 1) * 9999 + serial - 1,
                F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), key, F.lit("ssn"))
    made = F.transform(F.array(f), lambda x: F.concat_ws(
        "-", F.lpad((F.when(x.a >= 665, x.a + 2).otherwise(x.a + 1)).cast("string"), 3, "0"),
        F.lpad((F.floor(x.b / 9999) + 1).cast("string"), 2, "0"),
        F.lpad((F.pmod(x.b, F.lit(9999)) + 1).cast("string"), 4, "0")))
    return F.when(valid, F.element_at(made, 1))


def _ip(value: Column, key: str) -> Column:
    o = F.split(value, r"\.")
    part = [F.get(o, F.lit(i)).try_cast("long") for i in range(4)]
    valid = (part[0] < 256) & (part[1] < 256) & (part[2] < 256) & (part[3] < 256)
    size = F.lit(65536).cast("long")
    f = feistel(part[0] * 256 + part[1], part[2] * 256 + part[3], size, size, key, F.lit("ip"))
    made = F.transform(F.array(f), lambda x: F.concat_ws(
        ".", *[y.cast("string") for y in (F.floor(x.a / 256), F.pmod(x.a, F.lit(256)),
                                          F.floor(x.b / 256), F.pmod(x.b, F.lit(256)))]))
    return F.when(valid, F.element_at(made, 1))


#: Months of 31 days, those of one digit first in calendar order.
LONG_MONTHS = (1, 3, 5, 7, 8, 10, 12)


def _iso_date(value: Column, key: str) -> Column:
    """Days of one century onto each other."""
    found = F.try_to_date(value, "yyyy-MM-dd")
    century = F.floor(F.year(found) / 100).cast("int")
    leap = century % 4 == 0
    start = F.make_date(century * 100, F.lit(1), F.lit(1))
    # 36,524 days = 92 x 397; a century that starts with a leap year has 36,525 = 75 x 487
    size_a = F.when(leap, F.lit(75)).otherwise(F.lit(92)).cast("long")
    size_b = F.when(leap, F.lit(487)).otherwise(F.lit(397)).cast("long")
    n = F.datediff(found, start).cast("long")
    f = feistel(F.floor(n / size_b), F.pmod(n, size_b), size_a, size_b, key,
                F.concat(F.lit("date"), century.cast("string")))
    made = F.transform(F.array(f), lambda x: F.date_add(start, (x.a * size_b + x.b).cast("int")))
    return F.when(found.isNotNull(), F.date_format(F.element_at(made, 1), "yyyy-MM-dd"))


def _date(value: Column, key: str) -> Column:
    """Strings of one form and century onto each other.  A form is the sign between the
    parts, how many digits day and month have, and, since a string may be read day or
    month first, its class: both parts up to 12 (a date either way), or the day, in the
    place where it stands, 13-28, 29-30 outside February, 31, or 29 February."""
    sep = F.regexp_extract(value, "[/.-]", 0)
    p = [F.get(F.split(value, "[/.-]"), F.lit(i)) for i in range(3)]
    x0, x1, y = (p[i].try_cast("long") for i in range(3))
    w0, w1 = F.char_length(p[0]), F.char_length(p[1])
    first = x0 > 12  # the day comes first
    day, month = F.when(first, x0).otherwise(x1), F.when(first, x1).otherwise(x0)
    months = F.when(F.when(first, w1).otherwise(w0) == 1, F.lit(9)).otherwise(F.lit(12)).cast("long")
    either = (x0 <= 12) & (x1 <= 12)
    leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
    long_at = F.array_position(F.array(*map(F.lit, LONG_MONTHS)), month.cast("int")) - 1
    kind = (F.when(either & (x0 > 0) & (x1 > 0), "either")
            .when((month < 1) | (month > 12) | (day < 13) | (day > 31), F.lit(None))
            .when(day <= 28, "early").when((month == 2) & (day == 29) & leap, "leap")
            .when((month == 2) | (day == 31) & (long_at < 0), F.lit(None)).when(day == 31, "last").otherwise("late"))
    n1 = F.when(w1 == 1, F.lit(9)).otherwise(F.lit(12)).cast("long")
    n0 = F.when(w0 == 1, F.lit(9)).otherwise(F.lit(12)).cast("long")
    a = (F.when(kind == "either", (x0 - 1) * n1 + x1 - 1).when(kind == "early", (day - 13) * months + month - 1)
         .when(kind == "late", (day - 29) * (months - 1) + F.when(month > 2, month - 2).otherwise(0))
         .when(kind == "last", long_at).otherwise(0))
    size_a = (F.when(kind == "either", n0 * n1).when(kind == "early", 16 * months).when(kind == "late", 2 * (months - 1))
              .when(kind == "last", F.when(months == 9, 5).otherwise(7)).otherwise(1))
    century = F.floor(y / 100)
    # leap years of a century: 24, or 25 with its first year
    skip = F.when(century % 4 == 0, F.lit(0)).otherwise(F.lit(1))
    b = F.when(kind == "leap", F.floor(F.pmod(y, F.lit(100)) / 4) - skip).otherwise(F.pmod(y, F.lit(100)))
    size_b = F.when(kind == "leap", 25 - skip).otherwise(F.lit(100))
    f = feistel(a, b, size_a.cast("long"), size_b.cast("long"), key,
                F.concat_ws("|", F.lit("date"), century.cast("string"), sep, w0.cast("string"), w1.cast("string"), kind))

    def write(x: Column) -> Column:
        d = (F.when(kind == "early", F.floor(x.a / months) + 13).when(kind == "late", F.floor(x.a / (months - 1)) + 29)
             .when(kind == "last", 31).otherwise(29))
        at = F.pmod(x.a, F.greatest(months - 1, F.lit(1)))
        m = (F.when(kind == "early", F.pmod(x.a, months) + 1).when(kind == "late", F.when(at > 0, at + 2).otherwise(1))
             .when(kind == "last", F.get(F.array(*map(F.lit, LONG_MONTHS)), F.when(kind == "last", x.a).otherwise(0).cast("int"))).otherwise(2))
        one = F.when(kind == "either", F.floor(x.a / n1) + 1).when(first, d).otherwise(m)
        two = F.when(kind == "either", F.pmod(x.a, n1) + 1).when(first, m).otherwise(d)
        year = F.when(kind == "leap", (x.b + skip) * 4).otherwise(x.b)
        return F.concat(F.lpad(one.cast("string"), w0, F.lit("0")), sep, F.lpad(two.cast("string"), w1, F.lit("0")), sep,
                        F.lpad((century * 100 + year).cast("string"), 4, "0"))

    made = F.element_at(F.transform(F.array(f), write), 1)
    return F.when(sep == "-", _iso_date(value, key)).otherwise(F.when(kind.isNotNull(), made))


def _phone(value: Column, key: str) -> Column:
    """The country code stays, and so do the first digits of area code and, in a number
    of ten digits, of the exchange, which decide what is a number; the rest is permuted."""
    plus = value.startswith("+")
    code = F.when(plus, F.regexp_extract(value, r"^\+[0-9]{1,3}[ .(-]*", 0)).otherwise(F.lit(""))
    rest = F.substring(value, F.char_length(code) + 1, F.lit(100))
    d = _only_digits(rest)
    ten = F.char_length(d) == 10
    free = F.when(ten, F.concat(F.substring(d, 2, 2), F.substring(d, 5, 6))).otherwise(F.substring(d, F.lit(2), F.lit(100)))
    new = permute_digits(free, key, "phone")
    return F.concat(code, fill(rest, F.when(ten, F.concat(F.substring(d, 1, 1), F.substring(new, 1, 2), F.substring(d, 4, 1),
                                                          F.substring(new, 3, 6))).otherwise(F.concat(F.substring(d, 1, 1), new))))


def _email(value: Column, key: str) -> Column:
    at = F.split(F.lower(value), "@")
    name, host = F.get(at, F.lit(0)), F.get(at, F.lit(1))
    return F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), name, host), 256), 1, 12),
                    F.lit("@d"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), host), 256), 1, 8),
                    F.lit(".invalid"))


_MAKERS = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "ip": _ip, "date": _date, "phone": _phone}


def valid_numbers(t: Column) -> Column:
    """The valid IBANs and cards of a text as ``array<string>``, in the order in
    which they are to be tried at one place: IBANs of their country's length,
    other IBANs, cards, each the longest first."""
    def at_every_place(pattern: str) -> Column:
        return F.regexp_extract_all(t, F.lit(f"{_LEFT}(?=({pattern}))"), F.lit(1))

    def prefixes(m: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(15), F.char_length(m)), lambda n: F.struct(
            F.substring(m, F.lit(1), n).alias("v"), F.substring(m, n + 1, F.lit(1)).alias("next")))
        whole = F.filter(cut, lambda x: x.next.isin("", " ") & ~x.v.endswith(" ") & _iban_valid(x.v))
        return F.transform(whole, lambda x: x.v)

    none = F.array().cast("array<string>")
    ibans = F.flatten(F.transform(F.filter(at_every_place(IBAN), lambda m: F.char_length(m) >= 15), prefixes))
    ibans = F.when(t.rlike(_LEFT + IBAN), ibans).otherwise(none)
    runs = F.filter(at_every_place(CARD_RUN), lambda v: ~v.rlike(_OTHER_RUN))
    cards = F.filter(F.concat(runs, *[at_every_place(p) for p in CARD_GROUPS]), _card_valid)
    cards = F.when(t.rlike(r"[0-9](?:[ -]?[0-9]){12}"), cards).otherwise(none)
    known = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])

    def ranked(v: Column, rank: Column) -> Column:
        return F.struct(rank.alias("rank"), (-F.char_length(v)).alias("n"), v.alias("v"))

    ranks = F.concat(
        F.transform(ibans, lambda v: ranked(v, F.when(F.try_element_at(known, F.substring(v, 1, 2)) == F.char_length(
            F.regexp_replace(v, " ", "")), F.lit(0)).otherwise(F.lit(1)))),
        F.transform(cards, lambda v: ranked(v, F.lit(2))))
    return F.transform(F.sort_array(F.array_distinct(ranks)), lambda x: x.v)


def kind_of(value: Column, numbers: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS):
        kind = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    number = F.when(value.rlike("^[A-Z]"), F.lit("iban")).otherwise(F.lit("card"))
    return F.when(F.array_contains(numbers, value), number).otherwise(kind)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``pii: struct<text, found: array<struct<kind, new>>>``."""
    t = F.col("row")[text]
    got = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "pii"]).alias("row"))
    got = got.withColumn("numbers", valid_numbers(t))
    # valid numbers are literal text in the row's pattern, so what fails its check hides nothing
    own = F.concat(F.lit(_HEAD + "(?:"), F.array_join("numbers", "|"), F.lit(f"){_END}|{_TAIL}"))
    got = got.withColumn("pattern", F.when(F.size("numbers") > 0, own).otherwise(F.lit(PATTERN)))
    hits = F.when((F.size("numbers") > 0) | t.rlike(PATTERN), F.regexp_extract_all(t, F.col("pattern"), F.lit(0)))
    got = got.withColumn("hits", hits)
    got = got.withColumn("typed", F.transform("hits", lambda v: F.struct(
        v.alias("v"), kind_of(v, F.col("numbers")).alias("kind"))))

    def made(x: Column) -> Column:
        new = F.lit(None).cast("string")
        for name, maker in _MAKERS.items():
            new = F.when(x.kind == name, maker(x.v, key)).otherwise(new)
        return F.struct(x.kind.alias("kind"), x.v.alias("old"), new.alias("new"))

    got = got.withColumn("found", F.transform("typed", made))
    parts = F.zip_with(F.split(t, F.col("pattern"), -1), "found",
                       lambda gap, x: F.concat(gap, F.coalesce(x.new, x.old, F.lit(""))))
    out = F.when(F.col("found").isNull(), t).otherwise(F.concat_ws("", parts))
    kept = F.transform(F.filter(F.coalesce("found", F.array().cast("array<struct<kind:string,old:string,new:string>>")),
                                lambda x: x.new.isNotNull()), lambda x: F.struct(x.kind.alias("kind"), x.new.alias("new")))
    return got.select("row.*", F.struct(out.alias("text"), kept.alias("found")).alias("pii"))
