"""Format-preserving pseudonyms by keyed Feistel networks, with Spark expressions only.

Personal values are found by pattern, validated, and replaced by another value
of the same format; equal values get equal pseudonyms under one key, in all
documents. A value is a vector of digits, each with a radix of its own (ten for
a digit, 898 for the area of a social security number, ...), chosen so that the
vectors are exactly the valid values of the format. A Feistel network adds to
one half of the vector, digit by digit modulo the radix, a keyed hash of the
other half, in turns; so it permutes the valid values of a format, without
collisions and without search.

==========  ==========================================================================
card        13 to 19 digits, also in groups; the check digit is set anew, so a valid Luhn
            number stays valid and an invalid one invalid
ssn         ddd-dd-dddd with a valid area, group and serial; others stay
phone       North American numbers, with or without +1; area and exchange stay valid or invalid
iban        valid check digits (modulo 97), set anew
date        yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, mm/dd/yyyy that exist in the calendar: a date of
            the same 400 years of the calendar
ip          four numbers up to 255
email       the local part, letter for letter and digit for digit; the domain stays
hex         32 and more hexadecimal digits (keys, tokens) with a digit and a letter: digit for
            digit, letter for letter
==========  ==========================================================================

Other text stays as it is, byte by byte. Defined results: a null text stays null
and an empty one empty; documents without such values are unchanged; repeated rows
get equal results; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import let, table, unused

#: Parameter: the secret that selects the permutations. Set your own.
KEY = "tidemark-pseudonyms"
TURNS = 8

#: Patterns by kind, in the order of preference; no capturing groups.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[12][0-9]{3}-[0-9]{2}-[0-9]{2}|[12][0-9]{3}/[0-9]{2}/[0-9]{2}"
            r"|[0-9]{2}\.[0-9]{2}\.[12][0-9]{3}|[0-9]{2}/[0-9]{2}/[12][0-9]{3})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\.?[0-9])",
    "phone": r"(?<![0-9])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "hex": r"(?<![A-Za-z0-9])(?=[a-fA-F]*+[0-9])(?=[0-9]*+[a-fA-F])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: What every value has: without it a text is not searched.
HINT = r"[0-9][0-9./() -]*[0-9]|@[A-Za-z0-9]|[0-9a-fA-F]{32}"

#: Days in 400 years of the calendar, 189 * 773, and the first day of such a period.
PERIOD, PERIOD_PARTS, EPOCH = 146_097, (189, 773), "1800-01-01"


def chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, v: a + v)


def permute(vector: Column, label: Column, key: str = KEY, turns: int = TURNS) -> Column:
    """The Feistel network over ``vector``, array<struct<v long, r long>> of digits and radixes; array<long>.

    ``label`` (the kind of value) separates the permutations of formats.
    """
    def turn(state: Column, number: Column) -> Column:
        def added(fixed: Column) -> Column:
            # a hash draws 32 bits for each of 16 digits
            blocks = F.transform(
                F.sequence(F.lit(0), (F.size(state.left) / 16).cast("int")),
                lambda b: F.sha2(F.concat_ws("|", F.lit(key), label, number, F.size(state.left), b, fixed, F.lit(key)), 512))
            return let(blocks, lambda drawn: F.transform(state.left, lambda d, i: F.struct(
                ((d.v + F.conv(F.substr(F.get(drawn, (i / 16).cast("int")), (i % 16) * 8 + 1, F.lit(8)), 16, 10).cast("long"))
                 % d.r).alias("v"), d.r.alias("r"))))

        # the halves change places; a long one is hashed once, not for each block
        fixed = let(F.array_join(F.transform(state.right, lambda d: F.concat_ws(":", d.v, d.r)), ","),
                    lambda half: F.when(F.size(state.right) > 100, F.sha2(half, 512)).otherwise(half))
        return F.struct(state.right.alias("left"), let(fixed, added).alias("right"))

    def run(digits: Column) -> Column:
        half = (F.size(digits) / 2).cast("int")
        start = F.struct(F.slice(digits, 1, half).alias("left"),
                         F.slice(digits, half + 1, F.size(digits) - half).alias("right"))
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(turns)), start, turn,
            lambda s: F.transform(F.concat(s.left, s.right) if turns % 2 == 0 else F.concat(s.right, s.left), lambda d: d.v))

    return let(vector, run)


def digit(v: Column, r: int) -> Column:
    return F.struct(v.cast("long").alias("v"), F.lit(r).cast("long").alias("r"))


def char_digits(text: Column, letters: int = 26) -> Column:
    """Letters and digits of a text as digits of radix ``letters`` and 10; other characters are left out."""
    def one(c: Column) -> Column:
        return F.when(c.between("0", "9"), digit(F.ascii(c) - ord("0"), 10)).when(
            c.between("a", "z"), digit(F.ascii(c) - ord("a"), letters)).when(
            c.between("A", "Z"), digit(F.ascii(c) - ord("A"), letters))

    return F.filter(F.transform(chars(text), one), lambda d: d.isNotNull())


def digits(text: Column) -> Column:
    """The decimal digits of a text, as array<long>."""
    return F.transform(F.filter(chars(text), lambda c: c.between("0", "9")), lambda c: c.cast("long"))


def decimal(numbers: Column) -> Column:
    return F.transform(numbers, lambda v: digit(v, 10))


def rewrite(text: Column, values: Column) -> Column:
    """``text`` with its letters and digits replaced, in order, by those that ``values`` (a bound array<long>) stand for."""
    def step(acc: Column, c: Column) -> Column:
        base = F.when(c.between("0", "9"), ord("0")).when(c.between("a", "z"), ord("a")).when(c.between("A", "Z"), ord("A"))
        return let(base, lambda b: F.struct(
            F.concat(acc.text, F.when(b.isNull(), c).otherwise(F.char(b + F.get(values, acc.used)))).alias("text"),
            (acc.used + F.when(b.isNull(), 0).otherwise(1)).alias("used")))

    return F.aggregate(chars(text), F.struct(F.lit("").alias("text"), F.lit(0).alias("used")), step, lambda acc: acc.text)


def luhn_digit(payload: Column) -> Column:
    """The check digit of a bound array of digits."""
    doubled = F.transform(payload, lambda v, i: F.when(
        (F.size(payload) - i) % 2 == 1, F.when(v > 4, 2 * v - 9).otherwise(2 * v)).otherwise(v))
    return (10 - total(doubled) % 10) % 10


def mod97(text: Column) -> Column:
    """An IBAN's letters and digits, read as a number with A = 10 to Z = 35, modulo 97."""
    return F.aggregate(chars(text), F.lit(0), lambda a, c: F.when(
        c.between("0", "9"), (a * 10 + F.ascii(c) - ord("0")) % 97).otherwise((a * 100 + F.ascii(c) - ord("A") + 10) % 97))


@dataclass(frozen=True)
class Kind:
    """``vector``: the digits to permute, of a value; ``render``: the value, of it and the permuted digits.

    Each kind has a permutation of its own. A null vector leaves the value as it is.
    """

    vector: Callable[[Column], Column]
    render: Callable[[Column, Column], Column]


def at(values: Column, i: int) -> Column:
    return F.get(values, F.lit(i))


def card_vector(value: Column) -> Column:
    return let(digits(value), lambda d: decimal(F.slice(d, 1, F.size(d) - 1)))


def card(value: Column, out: Column) -> Column:
    def checked(d: Column) -> Column:
        # how far the check digit is off: 0 for a valid number
        off = let(F.slice(d, 1, F.size(d) - 1), lambda p: (F.element_at(d, -1) - luhn_digit(p) + 10) % 10)
        return let(F.concat(out, F.array((luhn_digit(out) + off) % 10)), lambda v: rewrite(value, v))

    return let(digits(value), checked)


def number(d: Column, first: int, last: int) -> Column:
    return reduce(lambda a, i: a * 10 + at(d, i), range(first + 1, last), at(d, first))


def ssn_valid(d: Column) -> Column:
    area = number(d, 0, 3)
    return (area > 0) & (area != 666) & (area < 900) & (number(d, 3, 5) > 0) & (number(d, 5, 9) > 0)


def ssn_vector(value: Column) -> Column:
    # valid numbers: areas 1 to 899 without 666 are 0 to 897; invalid ones: no permutation
    return let(digits(value), lambda d: F.when(ssn_valid(d), F.array(
        digit(number(d, 0, 3) - 1 - F.when(number(d, 0, 3) > 666, 1).otherwise(0), 898),
        digit(number(d, 3, 5) - 1, 99), digit(number(d, 5, 9) - 1, 9999))))


def ssn(value: Column, out: Column) -> Column:
    area = at(out, 0) + 1 + F.when(at(out, 0) + 1 >= 666, 1).otherwise(0)
    return F.format_string("%03d-%02d-%04d", area, at(out, 1) + 1, at(out, 2) + 1)


def phone_digits(value: Column) -> Column:
    return digits(F.regexp_replace(value, r"^\+1[ .-]?", ""))


def phone_vector(value: Column) -> Column:
    # the first digits of area (0) and exchange (3) stay within 2 to 9, or within 0 and 1
    def one(v: Column, i: Column) -> Column:
        return F.when(~i.isin(0, 3), digit(v, 10)).when(v > 1, digit(v - 2, 8)).otherwise(digit(v, 2))

    return F.transform(phone_digits(value), one)


def phone(value: Column, out: Column) -> Column:
    prefix = F.regexp_extract(value, r"^\+1[ .-]?", 0)

    def back(d: Column) -> Column:
        moved = F.transform(out, lambda v, i: v + F.when(i.isin(0, 3) & (F.get(d, i) > 1), 2).otherwise(0))
        return let(moved, lambda m: F.concat(prefix, rewrite(F.regexp_replace(value, r"^\+1[ .-]?", ""), m)))

    return let(phone_digits(value), back)


def iban_vector(value: Column) -> Column:
    account = F.substr(value, F.lit(5))
    return F.when(mod97(F.concat(account, F.substr(value, F.lit(1), F.lit(4)))) == 1, char_digits(account))


def iban(value: Column, out: Column) -> Column:
    country = F.substr(value, F.lit(1), F.lit(2))
    return let(rewrite(F.substr(value, F.lit(5)), out), lambda fresh: F.concat(
        country, F.lpad((98 - mod97(F.concat(fresh, country, F.lit("00")))).cast("string"), 2, "0"), fresh))


def date_format(value: Column) -> Column:
    return F.when(value.rlike("^[0-9]{4}-"), "yyyy-MM-dd").when(value.rlike("^[0-9]{4}/"), "yyyy/MM/dd") \
        .when(value.contains("."), "dd.MM.yyyy").otherwise("MM/dd/yyyy")


def day_number(value: Column) -> Column:
    """Days since ``EPOCH``; null for what is no date."""
    return F.datediff(F.try_to_timestamp(value, date_format(value)).cast("date"), F.lit(EPOCH).cast("date"))


def date_vector(value: Column) -> Column:
    a, b = PERIOD_PARTS
    return let(F.pmod(day_number(value), F.lit(PERIOD)), lambda day: F.when(
        day.isNotNull(), F.array(digit(F.floor(day / b), a), digit(day % b, b))))


def date(value: Column, out: Column) -> Column:
    day = day_number(value)
    fresh = day - F.pmod(day, F.lit(PERIOD)) + at(out, 0) * PERIOD_PARTS[1] + at(out, 1)
    return let(F.date_add(F.lit(EPOCH).cast("date"), fresh.cast("int")), lambda d: F.coalesce(*[
        F.when(date_format(value) == f, F.date_format(d, f)) for f in ("yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "MM/dd/yyyy")]))


def ip_vector(value: Column) -> Column:
    return F.transform(F.split(value, r"\."), lambda x: digit(x, 256))


def ip(value: Column, out: Column) -> Column:
    return F.array_join(F.transform(out, lambda v: v.cast("string")), ".")


def email_vector(value: Column) -> Column:
    return char_digits(F.substring_index(value, "@", 1))


def email(value: Column, out: Column) -> Column:
    return F.concat(rewrite(F.substring_index(value, "@", 1), out), F.lit("@"), F.substring_index(value, "@", -1))


def hex_key(value: Column, out: Column) -> Column:
    # letters and digits only, so each has the digit at its own place: linear, however long the key
    base = lambda c: F.when(c.between("0", "9"), ord("0")).when(c.between("a", "z"), ord("a")).otherwise(ord("A"))
    return F.array_join(F.transform(chars(value), lambda c, i: F.char(base(c) + F.get(out, i))), "")


KINDS = {
    "email": Kind(email_vector, email), "iban": Kind(iban_vector, iban), "date": Kind(date_vector, date),
    "ssn": Kind(ssn_vector, ssn), "ip": Kind(ip_vector, ip), "phone": Kind(phone_vector, phone),
    "card": Kind(card_vector, card), "hex": Kind(lambda v: char_digits(v, 6), hex_key),
}


def kind_of(value: Column) -> Column:
    """The first kind whose pattern the whole value has."""
    return F.coalesce(*[F.when(value.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in PATTERNS.items()])


def pick(kind: Column, by_kind: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(kind == k, c) for k, c in by_kind.items()])


def pseudonyms(found: Column, key: str = KEY) -> Column:
    """array<struct<old, new>> for an array of values; what its kind's validation refuses stays."""
    kinds = F.transform(found, lambda v: F.struct(v.alias("old"), kind_of(v).alias("kind")))
    vectors = F.transform(kinds, lambda x: F.struct(
        x.old.alias("old"), x.kind.alias("kind"), pick(x.kind, {k: m.vector(x.old) for k, m in KINDS.items()}).alias("vector")))
    moved = F.transform(vectors, lambda x: F.struct(
        x.old.alias("old"), x.kind.alias("kind"),
        F.when(x.vector.isNotNull(), permute(x.vector, x.kind, key)).alias("out")))
    return F.transform(moved, lambda x: F.struct(x.old.alias("old"), F.when(x.out.isNull(), x.old).otherwise(
        pick(x.kind, {k: m.render(x.old, x.out) for k, m in KINDS.items()})).alias("new")))


def pseudonymise(docs: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and, as ``n_pseudonyms``, how many values were replaced.

    The text is split at its values; a text without any passes unchanged. A column
    ``n_pseudonyms`` of ``docs`` is replaced.
    """
    own = [c for c in docs.columns if c != "n_pseudonyms"]
    values, new_text = unused(own, "__found"), unused(own, "__new")
    found = F.when(F.col(text).rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    rows = docs.select(*own, found.alias(values))
    gaps = F.split(text, PATTERN, -1)

    def rebuilt(new: Column) -> Column:
        tail = F.concat(F.transform(new, lambda x: x.new), F.array(F.lit("")))
        return F.struct(F.array_join(F.zip_with(gaps, tail, lambda g, v: F.concat(g, v)), "").alias("text"),
                        F.size(F.filter(new, lambda x: x.old != x.new)).cast("long").alias("n"))

    some = F.size(values) > 0  # null for null texts and for those without a hint
    rows = rows.withColumn(new_text, F.when(some, let(pseudonyms(F.col(values), key), rebuilt)))
    return rows.select(*[F.coalesce(F.col(new_text)["text"], text).alias(c) if c == text else F.col(c) for c in own],
                       F.coalesce(F.col(new_text)["n"], F.lit(0).cast("long")).alias("n_pseudonyms"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: all documents with pseudonyms."""
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))
