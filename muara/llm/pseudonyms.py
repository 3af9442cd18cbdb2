"""Format-preserving pseudonyms for personal data: a keyed Feistel permutation within each value's format.

Card numbers (Luhn), IBANs (mod 97), IPv4 addresses (0 to 255), telephone numbers (8 to 15 digits), dates (of the
calendar) and the local parts of e-mail addresses are found, validated, and permuted: digits stay digits, letters
stay letters of their case, punctuation stays, checksums are made anew, dates stay dates. The permutation is keyed
and depends on nothing but the value, so equal values get equal pseudonyms in all documents, and different ones
different. A value that fails its validation stays as it is.

Groups of digits with single blanks or hyphens between them are looked at as a whole: from left to right the longest
run of whole groups that is a valid card number is one (groups of four digits or more, but for the last), and what is
left between cards is searched for dates and telephone numbers. A date with two leading numbers is day first where that is a date, and else month first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from muara.llm.common import documents, free_names
from muara.llm.spans import characters

# Countries by the length of their IBANs.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC",
}
# Calling codes of one and two digits; the others have three.
CALLING_CODE = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _iban_of(countries: str, size: int) -> str:
    rest = f"(?: ?[A-Z0-9]{{{size % 4}}})" if size % 4 else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{size // 4 - 1}}}{rest}(?![A-Za-z0-9])"


# The formats, tried in this order at each place of a text. Groups that repeat without bound are possessive: Java
# matches these in a loop, and others by recursion, which ends the process on a long run. A country's IBAN has its
# length; the general form is for codes without one.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})++"
_KNOWN = "|".join(_iban_of(countries, size) for size, countries in IBAN_LENGTHS.items())
_CODES = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
_OTHERS = rf"(?!{_CODES})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?(?![A-Za-z0-9])"
IBAN = rf"(?<![A-Za-z0-9])(?:{_KNOWN}|{_OTHERS})"
DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9/-])"
ADDRESS = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])"
DIGITS = r"(?<![0-9A-Za-z])(?=(?:[ -]?[0-9]){13})[0-9]++(?![A-Za-z])(?:[ -][0-9]++(?![A-Za-z]))*+"
PHONE = (
    r"(?:\+[0-9]{1,3}[ .-]?)?\(?(?<![0-9])[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+[0-9]{8,15}(?![0-9A-Za-z])"
)
KINDS = {"email": EMAIL, "iban": IBAN, "date": DATE, "address": ADDRESS, "digits": DIGITS, "phone": PHONE}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: What is looked for between the cards of a run; a telephone number has no more groups on either side.
BETWEEN_CARDS = f"(?:{DATE})|(?<![0-9][ -])(?:{PHONE})(?![ -]?[0-9])"
#: Around a card within a run of digits, which has no such character.
MARK = "\x01"

ROUNDS = 10
#: Dates are permuted among the days of one 400-year cycle of the calendar from this day on: 27 times 5411 days.
FIRST_DAY, DAYS = "1800-01-01", (27, 5411)
#: The days of the cycle after the twelfth of their month, which alone can only be month first: 9 times 9833.
LATE_DAYS = (9, 9833)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def divided(value: Column, by: Column | int) -> Column:
    """Whole division; ``/`` is by doubles and loses digits."""
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by).try_cast("long"))


def _number(key: str, kind: str, turn: Column, value: Column) -> Column:
    """The keyed round function: a number below 2**60."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256), 1, 15), 16, 10).try_cast("long")


def permuted_number(value: Column, moduli: tuple[Column | int, Column | int], key: str, kind: str) -> Column:
    """A permutation of the whole numbers below the product of the moduli: they change in turn, keyed by the other."""
    a, b = moduli
    start = F.struct(divided(value, b).alias("a"), (value % b).try_cast("long").alias("b"))

    def turn(acc: Column, i: Column) -> Column:
        left = (acc["a"] + _number(key, kind, i, acc["b"])) % a
        right = (acc["b"] + _number(key, kind, i, acc["a"])) % b
        even = i % 2 == 0
        return F.struct(F.when(even, left).otherwise(acc["a"]).alias("a"), F.when(even, acc["b"]).otherwise(right).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: acc["a"] * b + acc["b"])


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of the strings of as many digits, at most 18: the halves change in turn as numbers."""

    def permuted(n: Column) -> Column:
        ten = lambda size: F.pow(F.lit(10.0), size).try_cast("long")
        half = F.floor(n / 2)
        new = permuted_number(digits.try_cast("long"), (ten(half), ten(n - half)), key, kind)
        return F.lpad(new.cast("string"), n, F.lit("0"))

    return bound(F.length(digits), permuted)


def _shifted(part: Column, by: Column) -> Column:
    """Each character moved on within its class by the bytes of a hash: digits, lower and upper letters; others stay."""

    def move(c: Column, step: Column) -> Column:
        def moved(code: Column) -> Column:
            turn = lambda low, size: F.when(code.between(low, low + size - 1), F.chr((code - low + step) % size + low))
            return F.coalesce(turn(48, 10), turn(97, 26), turn(65, 26), c)

        return bound(F.ascii(c), moved)

    def all_moved(hashed: Column) -> Column:
        step = lambda i: F.conv(F.substring(hashed, (i % 64) * 2 + 1, F.lit(2)), 16, 10).try_cast("int")
        return F.array_join(F.transform(characters(part), lambda c, i: move(c, step(i))), "")

    return bound(by, all_moved)


def permuted_text(value: Column, key: str, kind: str) -> Column:
    """A permutation of the strings of one shape: the halves change in turn, keyed by the other."""
    cut = F.floor(F.length(value) / 2).try_cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("a"), F.substring(value, cut + 1, F.length(value)).alias("b"))

    def turn(acc: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, acc["b"]).otherwise(acc["a"])
        by = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), F.length(value).cast("string"), other), 512)
        moved = _shifted(F.when(even, acc["a"]).otherwise(acc["b"]), by)
        return F.struct(F.when(even, moved).otherwise(acc["a"]).alias("a"), F.when(even, acc["b"]).otherwise(moved).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda acc: F.concat(acc["a"], acc["b"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _into_shape(shape: Column, fill: Column, what: str) -> Column:
    """The characters of ``fill`` put in turn into the places of ``shape`` that match ``what``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(acc: Column, c: Column) -> Column:
        fits = c.rlike(what)
        put = F.when(fits, F.substring(fill, acc["at"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(acc["out"], put).alias("out"), (acc["at"] + fits.try_cast("int")).alias("at"))

    return F.aggregate(characters(shape), start, step, lambda acc: acc["out"])


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of digits read from the right; those at places with ``place % 2 == doubled`` count twice."""

    def add(acc: Column, c: Column) -> Column:
        d = c.try_cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        value = F.when(acc["at"] % 2 == doubled, twice).otherwise(d)
        return F.struct((acc["sum"] + value).alias("sum"), (acc["at"] + 1).alias("at"))

    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("at"))
    return F.aggregate(characters(F.reverse(digits)), start, add, lambda acc: acc["sum"])


def _is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (F.regexp_replace(digits, "0", "") != "") & (_luhn_sum(digits, 1) % 10 == 0)


def _card(value: Column, key: str) -> Column:
    def permuted(digits: Column) -> Column:
        body = permuted_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        return bound(body, lambda b: _into_shape(value, F.concat(b, ((10 - _luhn_sum(b, 0) % 10) % 10).cast("string")), "^[0-9]$"))

    return bound(_digits(value), permuted)


def _with_cards_marked(value: Column) -> Column:
    """A run of digit groups with ``MARK`` around its cards: from left to right, the longest at a group first."""

    def marked(groups: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            group = F.get(groups, i)
            after = acc["at"] + F.length(group) + 1
            mark = F.when(i > 0, F.substring(value, acc["at"] - 1, F.lit(1))).otherwise("")
            sizes = F.sequence(F.lit(1), F.least(F.lit(5), F.size(groups) - i))
            long = lambda m: F.forall(F.slice(groups, i + 1, m - 1), lambda g: F.length(g) >= 4)
            valid = F.filter(sizes, lambda m: long(m) & _is_card(F.array_join(F.slice(groups, i + 1, m), "")))

            def taken(longest: Column) -> Column:
                card = F.substring(value, acc["at"], F.length(F.array_join(F.slice(groups, i + 1, longest), " ")))
                out = F.when(longest.isNull(), F.concat(acc["out"], mark, group)).otherwise(F.concat(acc["out"], mark, F.lit(MARK), card, F.lit(MARK)))
                return F.struct(out.alias("out"), after.alias("at"), (i + F.coalesce(longest, F.lit(1))).alias("until"))

            passed = F.struct(acc["out"].alias("out"), after.alias("at"), acc["until"].alias("until"))
            return F.when(i < acc["until"], passed).otherwise(bound(F.array_max(valid), taken))

        start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), F.lit(0).alias("until"))
        return F.aggregate(F.sequence(F.lit(0), F.size(groups) - 1), start, step, lambda acc: acc["out"])

    return bound(F.split(value, "[ -]"), marked)


def _in_digits(value: Column, key: str) -> Column:
    def between(gap: Column) -> Column:
        inner = rewritten(gap, BETWEEN_CARDS, lambda v: pseudonym(v, key, ("date", "phone")))
        return F.when(gap.rlike(BETWEEN_CARDS), inner).otherwise(gap)

    pieces = F.split(_with_cards_marked(value), MARK)
    return F.array_join(F.transform(pieces, lambda p, i: F.when(i % 2 == 1, _card(p, key)).otherwise(between(p))), "")


def _mod97(text: Column) -> Column:
    """Remainder by 97 of letters and digits, A as 10 to Z as 35."""

    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(characters(text), F.lit(0), add)


def _iban(value: Column, key: str) -> Column:
    plain = F.replace(value, F.lit(" "), F.lit(""))
    country, rest = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    valid = (_mod97(F.concat(rest, F.substring(plain, 1, 4))) == 1) & F.length(plain).between(15, 34)
    body = permuted_text(rest, key, "iban")
    check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(valid, _into_shape(value, F.concat(country, check, body), "^[A-Z0-9]$"))


def _address(value: Column, key: str) -> Column:
    parts = F.split(value, r"\.")
    octets = [F.get(parts, F.lit(i)).try_cast("int") for i in range(4)]
    number = reduce(lambda acc, o: acc * 256 + o, octets, F.lit(0).try_cast("long"))
    new = permuted_number(number, (65536, 65536), key, "address")
    shown = F.concat_ws(".", *[(F.shiftright(new, 8 * i) % 256).cast("string") for i in (3, 2, 1, 0)])
    return F.when(F.forall(parts, lambda p: p.try_cast("int") <= 255), shown)


def _date(value: Column, key: str) -> Column:
    start = F.lit(FIRST_DAY).cast("date")
    iso = F.substring(value, 5, 1) == "-"
    mark = F.when(iso, F.lit("-")).otherwise(F.substring(value, 3, 1))
    one, two, year = F.substring(value, 1, 2), F.substring(value, 4, 2), F.substring(value, 7, 4)
    read = lambda *parts: F.try_to_date(F.concat_ws("-", *parts), "yyyy-MM-dd")
    day = F.when(iso, F.try_to_date(value, "yyyy-MM-dd")).otherwise(read(year, two, one))
    same = iso | (F.substring(value, 6, 1) == F.substring(value, 3, 1))

    def number(found: Column) -> Column:
        return F.datediff(found, start).try_cast("long")

    def day_first(n: Column) -> Column:
        new = F.date_add(start, permuted_number(n, DAYS, key, "date").try_cast("int"))
        shown = lambda d: F.concat_ws("", F.date_format(d, "dd"), mark, F.date_format(d, "MM"), mark, F.date_format(d, "yyyy"))
        return F.when(
            n.between(0, DAYS[0] * DAYS[1] - 1), bound(new, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(shown(d)))
        )

    def month_first(found: Column) -> Column:
        months = (F.year(found) - int(FIRST_DAY[:4])) * 12 + F.month(found) - 1
        place = number(found) - 12 * (months + 1)  # among the days after the twelfth
        begins = lambda m: number(F.add_months(start, m)) - 12 * m

        def shown(r: Column) -> Column:
            guess = F.floor(r / F.lit(18.437)).try_cast("int")
            near = F.filter(F.sequence(F.greatest(guess - 2, F.lit(0)), guess + 2), lambda m: begins(m) <= r)
            day = lambda m: F.date_add(F.add_months(start, m), (r - begins(m) + 12).try_cast("int"))
            return bound(
                F.array_max(near),
                lambda m: F.concat_ws("", F.date_format(day(m), "MM"), mark, F.date_format(day(m), "dd"), mark, F.date_format(day(m), "yyyy")),
            )

        in_cycle = F.year(found).between(int(FIRST_DAY[:4]), int(FIRST_DAY[:4]) + 399)
        return F.when(in_cycle, bound(permuted_number(place, LATE_DAYS, key, "late"), shown))

    late = F.when(~iso & day.isNull(), read(year, one, two))
    return F.when(same, F.coalesce(bound(number(day), day_first), bound(late, month_first)))


def _phone(value: Column, key: str) -> Column:
    spaced = F.regexp_extract(value, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    country = F.when(spaced != "", spaced).otherwise(F.regexp_extract(value, CALLING_CODE, 0))

    def permuted(code: Column) -> Column:
        rest = F.substring(value, F.length(code) + 1, F.length(value))
        new = lambda digits: F.concat(code, _into_shape(rest, permuted_digits(digits, key, "phone"), "^[0-9]$"))
        valid = lambda digits: (F.length(digits) + F.length(code)).between(9, 16)
        return bound(_digits(rest), lambda digits: F.when(valid(digits), new(digits)))

    return bound(country, permuted)


def _email(value: Column, key: str) -> Column:
    local, domain = F.regexp_extract(value, "^([^@]*)@", 1), F.regexp_extract(value, "(@.*)$", 1)
    return F.concat(permuted_text(local, key, "email"), domain)


_PERMUTED = {"email": _email, "iban": _iban, "date": _date, "address": _address, "digits": _in_digits, "phone": _phone}


def pseudonym(value: Column, key: str, kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    """The pseudonym of one found value; the value itself where it is not valid in any format it has."""
    out = value
    for kind in reversed(kinds):
        own = F.coalesce(_PERMUTED[kind](value, key), value)
        out = F.when(value.rlike(f"^(?:{KINDS[kind]})$"), own).otherwise(out)
    return out


def rewritten(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """A text with every match of a pattern replaced."""
    values = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), new)
    return F.array_join(F.zip_with(F.split(text, pattern, -1), values, lambda gap, v: F.concat(gap, F.coalesce(v, F.lit("")))), "")


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` rewritten and ``n_found`` and ``n_replaced``, the places met and those changed.

    Null text stays null with zero counts. Texts without a value stay as they are. Repeated rows and equal or null
    ids are rewritten row by row alike. Other columns pass through; ``n_found`` and ``n_replaced`` are replaced. A run
    of digit groups is one place, however many values are in it.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("text", "n_found", "n_replaced")]
    old, new = free_names(docs, "found", "new")
    has = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    values = docs.select(*columns, "text", F.when(has, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias(old))
    values = values.withColumn(new, F.transform(old, lambda v: pseudonym(v, key)))
    gaps = F.split("text", PATTERN, -1)
    joined = F.array_join(F.zip_with(gaps, new, lambda gap, v: F.concat(gap, F.coalesce(v, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x))
    met = F.col(old).isNotNull()
    return values.select(
        *columns,
        F.when(met, joined).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.when(met, F.size(old)), F.lit(0)).try_cast("long").alias("n_found"),
        F.coalesce(F.when(met, changed), F.lit(0)).try_cast("long").alias("n_replaced"),
    )


def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").try_cast("long"), "text")
    return pseudonymised(docs, "muara-demonstration-key")
