"""Format-preserving pseudonyms for personal numbers, dates and addresses (operator 1).

Validated values are replaced by a keyed permutation within their own format, so
a value has the same pseudonym in every document, two values never share one,
and whoever has the key can undo it (``inverse=True``):

* card numbers (Luhn): first digit and separators stay, the check digit is computed anew
* phone numbers: country code and leading digits of the parts stay
* IPv4 addresses: permuted among all addresses
* US social security numbers: permuted among the valid ones
* IBANs (mod 97): digits of the account part are permuted, the check digits computed anew
* dates from 1900 to 2099 (ISO; month/day/year or day.month.year): permuted among the days from 1900-01-01 to 2100-01-01
* e-mail addresses: letters and digits of the local part, each within its kind

The permutations are Feistel networks: each round moves one half by an amount that
a keyed digest of the other half gives. Everything is built from SQL functions.

Defined cases: a null text stays null and has no values; an empty one stays
empty; what has the shape of a value but fails its check stays as it is; values
in very long texts are replaced like others. Card numbers and IBANs are looked
for among the groups of a run of numbers, in their usual grouping first and then
in every other one, so neighbours hide none. Numbers of tables are not cards: in
another grouping a card needs the first digits and the length of an issuer and
no neighbour of the size of the group next to it; in groups of the usual sizes it
needs one of the two. Numbers that pass all this by chance are replaced. Only the
first digit of a card stays, so undoing finds a card that needed its issuer only
where the pseudonym has one too. Dates that are not padded come back
padded or not as their own digits require. Repeated rows are kept; an empty
table gives an empty one; input columns with the name of a result column go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwatch.llm.shared import without

KEY = "tillwatch"  # a deployment passes its own
ROUNDS = 8
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()

# Fixed formats.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+(?<=\.[A-Za-z]{2,24})"
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)"
         r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)")
CARD = r"\d(?:[ -]?\d){12,18}"
ISSUERS = (r"4\d{12}(?:\d{3}){0,2}|(?:5[1-5]\d{2}|222[1-9]|22[3-9]\d|2[3-6]\d{2}|27[01]\d|2720)\d{12}|3[47]\d{13}"
           r"|3(?:0[0-5]|[689]\d)\d{11}|(?:6011|65\d{2}|64[4-9]\d)\d{12}|35(?:2[89]|[3-8]\d)\d{12}|62\d{14,17}")
CARD_SHAPES = ((4, r"\d{4}(?:[ -]\d{4}){3}"), (3, r"\d{4}[ -]\d{6}[ -]\d{4,5}"), (1, r"\d{13,19}"))  # by number of groups
THREE_GROUPS = r"\d{3}-\d{2}-\d{4}|\d{4}-\d{2}-\d{2}"  # numbers and dates that no hyphen may precede or follow
THREE_PHONE = r"\d{3}[ -]\d{3}[ -]\d{4}"
# A run is all groups of digits (from an IBAN's start on, of capitals too) over single blanks or hyphens, up to
# one that starts a value of another shape.
OTHER = (r"(?![A-Za-z0-9._%+-]{1,256}+@|(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)|\d{1,2}/\d{1,2}/\d{4}(?![\d/-]|\.\d)"
         r"|\d{1,2}\.\d{1,2}\.\d{4}(?![\d/-]|\.\d)|\d{3}(?:\.\d{3}[ .-]|[ -]\d{3}\.)\d{4}(?!\d))")
IBAN_RUN = (r"(?<![A-Za-z0-9])(?=[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11})[A-Z0-9]++(?![a-z])"
            rf"(?:[ -]{OTHER}[A-Z0-9]++(?![a-z]))*+")
CARD_RUN = rf"(?<!\d)(?=\d(?:[ -]?\d){{12}})\d++(?:[ -]{OTHER}\d++)*+"
RUN = r"^(?:[A-Z][A-Z0-9 -]*+|\d(?:[ -]?\d){12}[\d -]*+)$"
ANY = f"{EMAIL}|{IBAN_RUN}|(?=[+(0-9])(?:{IP}|{DATE}|{SSN}|{CARD_RUN}|{PHONE})"
MOST_GROUPS = 19  # of a card number
IBAN_GROUPS = 9
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
HINT = "[0-9@]"
FIRST_DAY, DAYS_LEFT, DAYS_RIGHT = "1900-01-01", 150, 487  # 73,050 days
COLUMNS = ("n_private",)


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat_ws(":", *[p.cast("string") for p in parts]), 256)


def rounds(inverse: bool) -> Column:
    order = range(ROUNDS, 0, -1) if inverse else range(1, ROUNDS + 1)
    return F.array(*map(F.lit, order))


def permute_pair(x: Column, y: Column, size_x: int, size_y: int, key: str, kind: str, inverse: bool) -> Column:
    """A keyed permutation of the pairs (x, y) with x below size_x and y below size_y, as a struct (x, y)."""
    long = lambda c: c.cast("long")
    start = F.struct(long(x).alias("x"), long(y).alias("y"),
                     long(F.lit(size_x)).alias("mx"), long(F.lit(size_y)).alias("my"))

    def amount(i: Column, value: Column) -> Column:
        return long(F.conv(F.substring(digest(F.lit(key), F.lit(kind), i, value), 1, 15), 16, 10))

    def forth(s: Column, i: Column) -> Column:
        moved = (s["x"] + amount(i, s["y"]) % s["mx"]) % s["mx"]
        return F.struct(s["y"].alias("x"), moved.alias("y"), s["my"].alias("mx"), s["mx"].alias("my"))

    def back(s: Column, i: Column) -> Column:
        moved = F.pmod(s["y"] - amount(i, s["x"]) % s["my"], s["my"])
        return F.struct(moved.alias("x"), s["x"].alias("y"), s["my"].alias("mx"), s["mx"].alias("my"))

    return F.reduce(rounds(inverse), start, back if inverse else forth)


def rotate(text: Column, by: Column, inverse: bool) -> Column:
    """Each digit or ASCII letter moved on within its kind, by four hex digits of ``by`` per place."""

    def moved(c: Column, p: Column) -> Column:
        # A digest has 16 groups of four digits; later places take a digest of their own.
        own = F.when(p < 16, by).otherwise(digest(by, F.floor(p / 16)))
        step = F.conv(F.substring(own, (p % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        out = c
        for kind in (DIGITS, LOWER, UPPER):
            at = F.instr(F.lit(kind), c) - 1
            to = F.pmod(at - step, F.lit(len(kind))) if inverse else (at + step) % len(kind)
            out = F.when(at >= 0, F.substring(F.lit(kind), to + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), moved), "")


def permute_text(text: Column, key: str, kind: str, inverse: bool) -> Column:
    """A keyed permutation of the texts with the same kinds of characters in the same places."""
    half = F.floor(F.length(text) / 2).cast("int")
    left, right = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    def by(i: Column, other: Column) -> Column:
        return digest(F.lit(key), F.lit(kind), i, other)

    def forth(s: Column, i: Column) -> Column:
        return F.struct(s["y"].alias("x"), rotate(s["x"], by(i, s["y"]), False).alias("y"))

    def back(s: Column, i: Column) -> Column:
        return F.struct(rotate(s["y"], by(i, s["x"]), True).alias("x"), s["x"].alias("y"))

    start = F.struct(left.alias("x"), right.alias("y"))
    return F.reduce(rounds(inverse), start, back if inverse else forth, lambda s: F.concat(s["x"], s["y"]))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def with_digits(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""

    def step(s: Column, c: Column) -> Column:
        is_digit = F.instr(F.lit(DIGITS), c) > 0
        put = F.when(is_digit, F.substring(digits, s["k"], F.lit(1))).otherwise(c)
        return F.struct(F.concat(s["out"], put).alias("out"), (s["k"] + is_digit.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    return F.reduce(F.split(shape, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number whose last digit is its check digit."""

    def value(c: Column, p: Column) -> Column:
        d = c.cast("int")
        return F.when(p % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.reduce(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda s, v: s + v)


def card(m: Column, key: str, inverse: bool) -> Column:
    digits = digits_of(m)
    n = F.length(digits)
    body = F.concat(F.substring(digits, 1, 1),
                    permute_text(F.substring(digits, F.lit(2), n - 2), key, "card", inverse))
    check = (10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    return F.when(luhn_sum(digits) % 10 == 0, with_digits(m, F.concat(body, check.cast("string"))))


def phone(m: Column, key: str, inverse: bool) -> Column:
    """Of the last ten digits, the first of the area and of the exchange stay; a shorter number keeps two."""
    digits = digits_of(m)
    n = F.length(digits)
    part = lambda start, length: F.substring(digits, start, F.lit(length))
    long_tail = permute_text(F.concat(part(n - 8, 2), part(n - 5, 2), part(n - 3, 4)), key, "phone", inverse)
    ten = F.concat(F.substring(digits, F.lit(1), n - 9), F.substring(long_tail, 1, 2), part(n - 6, 1),
                   F.substring(long_tail, 3, 6))
    short = F.concat(F.substring(digits, 1, 2),
                     permute_text(F.substring(digits, F.lit(3), n), key, "phone", inverse))
    return F.when(n >= 10, with_digits(m, ten)).when(n >= 7, with_digits(m, short))


def ip(m: Column, key: str, inverse: bool) -> Column:
    octet = F.transform(F.split(m, r"\."), lambda c: c.cast("int"))
    at = lambda i: F.element_at(octet, i)
    pair = permute_pair(at(1) * 256 + at(2), at(3) * 256 + at(4), 65536, 65536, key, "ip", inverse)

    def joined(p: Column) -> Column:
        numbers = [F.floor(p["x"] / 256), p["x"] % 256, F.floor(p["y"] / 256), p["y"] % 256]
        return F.concat_ws(".", *[v.cast("string") for v in numbers])

    return F.when(F.array_max(octet) <= 255, F.element_at(F.transform(F.array(pair), joined), 1))


def ssn(m: Column, key: str, inverse: bool) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    area, group, serial = (F.split(m, "-")[i].cast("int") for i in range(3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - (area > 666).cast("int")
    pair = permute_pair(rank, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn", inverse)

    def joined(p: Column) -> Column:
        new = p["x"] + 1 + (p["x"] >= 665).cast("int")
        return F.format_string("%03d-%02d-%04d", new, F.floor(p["y"] / 9999) + 1, p["y"] % 9999 + 1)

    return F.when(valid, F.element_at(F.transform(F.array(pair), joined), 1))


def date(m: Column, key: str, inverse: bool) -> Column:
    def moved(pattern: str) -> Column:
        day = F.datediff(F.try_to_timestamp(m, F.lit(pattern)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        pair = permute_pair(F.floor(day / DAYS_RIGHT), day % DAYS_RIGHT, DAYS_LEFT, DAYS_RIGHT, key, "date", inverse)
        new = F.element_at(F.transform(F.array(pair), lambda p: F.date_format(
            F.date_add(F.lit(FIRST_DAY).cast("date"), (p["x"] * DAYS_RIGHT + p["y"]).cast("int")), pattern)), 1)
        return F.when(day.between(0, DAYS_LEFT * DAYS_RIGHT - 1), new)

    padded = F.rlike(m, F.lit(r"^\d\d.\d\d."))
    return (
        F.when(F.instr(m, "-") > 0, moved("yyyy-MM-dd"))
        .when(F.instr(m, "/") > 0, F.when(padded, F.coalesce(moved("MM/dd/yyyy"), moved("dd/MM/yyyy")))
              .otherwise(F.coalesce(moved("M/d/yyyy"), moved("d/M/yyyy"))))
        .otherwise(F.when(padded, moved("dd.MM.yyyy")).otherwise(moved("d.M.yyyy")))
    )


def mod97(text: Column) -> Column:
    """The text, letters read as 10 to 35, modulo 97."""

    def step(s: Column, c: Column) -> Column:
        at = F.instr(F.lit(UPPER), c)
        return F.when(at > 0, (s * 100 + at + 9) % 97).otherwise((s * 10 + F.instr(F.lit(DIGITS), c) - 1) % 97)

    return F.reduce(F.split(text, ""), F.lit(0), step)


def valid_iban(plain: Column) -> Column:
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    return F.length(plain).between(15, 34) & (mod97(turned) == 1)


def iban(m: Column, key: str, inverse: bool) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    new = with_digits(account, permute_text(digits_of(account), key, "iban", inverse))
    check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(valid_iban(plain), with_digits(m, F.concat(check, digits_of(new))))


def email(m: Column, key: str, inverse: bool) -> Column:
    at = F.instr(m, "@")
    local = permute_text(F.substring(m, F.lit(1), at - 1), key, "email", inverse)
    return F.concat(local, F.substring(m, at, F.length(m)))


def pseudonym(m: Column, key: str = KEY, inverse: bool = False) -> Column:
    """The pseudonym of one matched value; null if it fails the check of its kind."""
    whole = lambda pattern: F.rlike(m, F.lit(f"^(?:{pattern})$"))
    return (
        F.when(F.instr(m, "@") > 0, email(m, key, inverse))
        .when(F.rlike(m, F.lit("^[A-Z]")), iban(m, key, inverse))
        .when(whole(IP), ip(m, key, inverse))
        .when(whole(DATE), date(m, key, inverse))
        .when(whole(SSN), ssn(m, key, inverse))
        .when(whole(CARD), card(m, key, inverse))
        .when(whole(PHONE), phone(m, key, inverse))
    )


def shape_of(text: Column, pattern: str) -> Column:
    return F.rlike(text, F.lit(f"^(?:{pattern})$"))


def values_of_run(groups: Column) -> Column:
    """Places (at, n) of the values in a run's ``groups``, each with the separator before it.

    First come IBANs and cards of the usual grouping, then numbers, dates and phones of
    three groups, then issuers' cards in any grouping, the longest first; from left to right.
    """
    size = F.size(groups)

    def joined(i: Column, n: Column | int) -> Column:
        return F.regexp_replace(F.array_join(F.slice(groups, i + 1, n if isinstance(n, Column) else F.lit(n)), ""), "^[ -]", "")

    def longest(i: Column, most: int, fits) -> Column:
        n = F.sequence(F.least(F.lit(most), size - i), F.lit(1), F.lit(-1))
        return F.coalesce(F.get(F.filter(n, fits), F.lit(0)), F.lit(0))

    def in_table(i: Column, n: Column | int) -> Column:
        """Whether the group before or after has as many characters as the one next to it."""
        length = lambda at: F.length(F.regexp_replace(F.get(groups, at), "^[ -]", ""))
        return F.coalesce(length(i - 1) == length(i), F.lit(False)) | F.coalesce(
            length(i + n) == length(i + n - 1), F.lit(False))

    def usual(_: Column, i: Column) -> Column:
        def is_iban(n: Column, lengths: dict[int, str] | None) -> Column:
            plain = F.replace(joined(i, n), F.lit(" "), F.lit(""))
            fits = F.lit(True)
            if lengths:
                own = F.lit(None)
                for length, countries in lengths.items():
                    own = F.when(F.substring(plain, 1, 2).isin(countries.split()), length).otherwise(own)
                fits = F.coalesce(F.length(plain) == own, F.lit(False))
            return F.when(fits & shape_of(joined(i, n), IBAN), valid_iban(plain)).otherwise(False)

        iban_groups = longest(i, IBAN_GROUPS, lambda n: is_iban(n, IBAN_LENGTHS))
        any_iban = longest(i, IBAN_GROUPS, lambda n: is_iban(n, None))
        found = F.lit(0)
        for n, pattern in reversed(CARD_SHAPES):
            digits = digits_of(joined(i, n))
            sure = ~in_table(i, n) | shape_of(digits, ISSUERS) if n > 1 else F.lit(True)
            fits = F.when(shape_of(joined(i, n), pattern) & sure, luhn_sum(digits) % 10 == 0).otherwise(False)
            found = F.when(fits, n).otherwise(found)
        starts = F.rlike(F.get(groups, i), F.lit(r"^[ -]?[A-Z]{2}\d{2}"))
        return F.when(starts, F.when(iban_groups > 0, iban_groups).otherwise(any_iban)).otherwise(found)

    def clear(taken: Column, i: Column, n: Column | int) -> Column:
        """Whether no better value starts among the groups after the first."""
        return F.coalesce(F.array_max(F.slice(taken, i + 2, F.lit(n) - 1 if isinstance(n, int) else n - 1)), F.lit(0)) == 0

    def by_three(first: Column):
        def of(n: Column, i: Column) -> Column:
            apart = ~F.startswith(F.get(groups, i), F.lit("-")) & ~F.startswith(
                F.coalesce(F.get(groups, i + 3), F.lit("")), F.lit("-"))
            text = joined(i, 3)
            fits = (shape_of(text, THREE_PHONE) | (shape_of(text, THREE_GROUPS) & apart)) & clear(first, i, 3)
            return F.when(n > 0, n).when(F.when(fits, pseudonym(text).isNotNull()).otherwise(False), 3).otherwise(0)

        return F.transform(first, of)

    def any_card(better: Column):
        def of(n: Column, i: Column) -> Column:
            def is_card(k: Column) -> Column:
                text = joined(i, k)
                issued = F.when(shape_of(text, CARD), shape_of(digits_of(text), ISSUERS)).otherwise(False)
                fits = issued & clear(better, i, k) & ~in_table(i, k)
                return F.when(fits, luhn_sum(digits_of(text)) % 10 == 0).otherwise(False)

            return F.when(n > 0, n).otherwise(longest(i, MOST_GROUPS, is_card))

        return F.transform(better, of)

    def once(value: Column, then) -> Column:
        """``then`` of a value that is worked out one time."""
        return F.element_at(F.transform(F.array(value), then), 1)

    def pick(s: Column, n: Column) -> Column:
        free = (n > 0) & (s["at"] >= s["end"])
        place = F.struct(s["at"].alias("at"), n.alias("n"))
        return F.struct((s["at"] + 1).alias("at"), F.when(free, s["at"] + n).otherwise(s["end"]).alias("end"),
                        F.when(free, F.concat(s["found"], F.array(place))).otherwise(s["found"]).alias("found"))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("end"),
                     F.array().cast("array<struct<at:int,n:int>>").alias("found"))
    return once(F.transform(groups, usual), lambda first: once(
        by_three(first), lambda better: F.reduce(any_card(better), start, pick, lambda s: s["found"])))


def parted(m: Column) -> Column:
    """A match as an array of (before, value): the values in it and the text before each; the last value may be null."""

    def of_run(groups: Column, places: Column) -> Column:
        def part(p: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(places, k - 1)["at"] + F.get(places, k - 1)["n"]).otherwise(0)
            value = F.array_join(F.slice(groups, p["at"] + 1, p["n"]), "")
            mark = F.regexp_extract(value, "^[ -]?", 0)
            return F.struct(F.concat(F.array_join(F.slice(groups, before + 1, p["at"] - before), ""), mark).alias("before"),
                            F.substring(value, F.length(mark) + 1, F.length(value)).alias("value"))

        end = F.coalesce(F.get(places, F.size(places) - 1)["at"] + F.get(places, F.size(places) - 1)["n"], F.lit(0))
        tail = F.struct(F.array_join(F.slice(groups, end + 1, F.size(groups)), "").alias("before"),
                        F.lit(None).cast("string").alias("value"))
        return F.concat(F.transform(places, part), F.array(tail))

    runs = F.transform(F.array(F.split(m, "(?=[ -])")), lambda g: F.struct(g.alias("g"), values_of_run(g).alias("p")))
    in_run = F.element_at(F.transform(runs, lambda r: of_run(r["g"], r["p"])), 1)
    alone = F.array(F.struct(F.lit("").alias("before"), m.alias("value")))
    return F.when(F.rlike(m, F.lit(RUN)), in_run).otherwise(alone)


def pseudonymise(docs: DataFrame, key: str = KEY, inverse: bool = False) -> DataFrame:
    """``docs`` with the values in ``text`` replaced and ``n_private``, the number of values replaced."""
    docs = without(docs, *COLUMNS)
    text, some = F.col("text"), F.rlike("text", F.lit(HINT))

    def replaced(parts: Column) -> Column:
        new = F.transform(parts, lambda p: F.struct(p.alias("old"), pseudonym(p["value"], key, inverse).alias("new")))
        return F.struct(
            F.array_join(F.transform(new, lambda p: F.concat(p["old"]["before"], F.coalesce(
                p["new"], p["old"]["value"], F.lit("")))), "").alias("text"),
            F.size(F.filter(new, lambda p: p["new"].isNotNull())).alias("n"))

    found = docs.withColumn("_found", F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    found = found.withColumn("_new", F.when(
        F.size("_found") > 0, F.transform(F.transform("_found", parted), replaced)))
    # split() parts the text at the same places where regexp_extract_all() finds values, which are never empty.
    pieces = F.zip_with(F.split(text, ANY, -1), F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b["text"], F.lit(""))))
    total = F.reduce("_new", F.lit(0), lambda s, v: s + v["n"])
    return found.withColumns({
        "text": F.when(F.size("_new") > 0, F.array_join(pieces, "")).otherwise(text),
        "n_private": F.coalesce(total, F.lit(0)).cast("long"),
    }).select(*docs.columns, *COLUMNS)
