"""Format-preserving pseudonyms for personal data, in built-in functions only.

What looks like a card, account, social-security or telephone number, an address of a machine or person, a
date or a secret is validated and then permuted by a keyed Feistel network within its own format.  A
permutation maps equal values to equal pseudonyms in all documents and different ones to different ones,
and whoever has the key can undo it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lyceum.llm.exact_dedup import columns_of, unused

ROUNDS = 8
FIRST_DAY, DAYS_A, DAYS_B = "1800-01-01", 189, 773  # 400 years of the calendar: 189 x 773 days


def keystream(key: str, kind: str, turn: Column, half: Column) -> Column:
    """64 hexadecimal digits that depend on the key, the kind of value, the round and the other half."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), half.cast("string")), 256)


def amount(stream: Column, at: Column | int = 0) -> Column:
    """A number below 2^24 from six digits of the stream."""
    start = F.pmod(F.lit(at) * 6 if isinstance(at, int) else at * 6, F.lit(58)) + 1
    return F.conv(F.substring(stream, start, F.lit(6)), 16, 10).cast("long")


def turns() -> Column:
    return F.sequence(F.lit(1), F.lit(ROUNDS))


def feistel_numbers(low: Column, high: Column, a: int, b: int, key: str, kind: str) -> Column:
    """A permutation of pairs (low < a, high < b): each half is moved, modulo its size, by the other one."""
    start = F.struct(low.cast("long").alias("low"), high.cast("long").alias("high"))
    return F.aggregate(turns(), start, lambda s, turn: F.when(
        turn % 2 == 1, F.struct(
            ((s["low"] + amount(keystream(key, kind, turn, s["high"]))) % a).alias("low"), s["high"].alias("high"))
    ).otherwise(F.struct(
        s["low"].alias("low"), ((s["high"] + amount(keystream(key, kind, turn, s["low"]))) % b).alias("high"))))


def moved(text: Column, stream: Column, letters: int) -> Column:
    """Every digit moved within the digits, every letter within the first ``letters`` of its case."""
    def one(c: Column, i: Column) -> Column:
        by, code = amount(stream, i), F.ascii(c)
        return (F.when(c.between("0", "9"), F.char((code - 48 + by) % 10 + 48))
                .when(c.between("a", "z"), F.char((code - 97 + by) % letters + 97))
                .when(c.between("A", "Z"), F.char((code - 65 + by) % letters + 65))
                .otherwise(c))
    return F.when(F.length(text) > 0, F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def feistel_text(text: Column, key: str, kind: str, letters: int = 26) -> Column:
    """A permutation of texts of one format: the halves move each other, character by character."""
    cut = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), cut).alias("left"), F.substring(text, cut + 1, F.length(text)).alias("right"))
    end = F.aggregate(turns(), start, lambda s, turn: F.struct(
        s["right"].alias("left"), moved(s["left"], keystream(key, kind, turn, s["right"]), letters).alias("right")))
    return F.concat(end["left"], end["right"])  # an even number of rounds puts the halves back in place


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), use)[0]


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def laid_out(like: Column, digits: Column) -> Column:
    """``digits`` in the places where ``like`` has digits."""
    def put(new: Column) -> Column:
        return F.array_join(F.transform(F.split(like, ""), lambda c, i: F.when(c.between("0", "9"), F.substring(
            new, F.length(digits_of(F.substring(like, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
    return bound(digits, put)


def card(m: Column, key: str) -> Column:
    """A number with a right check digit: the others are permuted, the check digit follows."""
    digits = digits_of(m)
    body = feistel_text(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
    valid = lambda x: F.call_function("luhn_check", x)
    checked = bound(body, lambda b: F.concat(b, F.array_join(
        F.filter(F.split(F.lit("0123456789"), ""), lambda d: valid(F.concat(b, d))), "")))
    return F.when(valid(digits), laid_out(m, checked)).otherwise(m)


def mod97(text: Column) -> Column:
    return F.aggregate(F.split(text, ""), F.lit(0), lambda total, c: F.when(
        c.between("0", "9"), (total * 10 + F.ascii(c) - 48) % 97).otherwise((total * 100 + F.ascii(c) - 55) % 97))


def account(m: Column, key: str) -> Column:
    """An international account number whose check digits are right: the account is permuted, they follow."""
    flat = F.regexp_replace(m, " ", "")
    country, own = F.substring(flat, 1, 2), F.substring(flat, F.lit(5), F.length(flat))
    valid = mod97(F.concat(own, F.substring(flat, 1, 4))) == 1
    made = bound(feistel_text(own, key, "account"), lambda new: F.concat(
        country, F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0"), new))
    spaced = F.trim(F.regexp_replace(made, "(.{4})", "$1 "))
    return F.when(~valid, m).when(m.contains(" "), spaced).otherwise(made)


def social(m: Column, key: str) -> Column:
    """Area 1-899 but 666, group 1-99, serial 1-9999."""
    area, group, serial = (F.substring(m, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("int")
    new = feistel_numbers(place, (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "social")
    sep = F.substring(m, 4, 1)
    made = bound(new, lambda x: F.concat(
        F.lpad((x["low"] + 1 + (x["low"] >= 665).cast("int")).cast("string"), 3, "0"), sep,
        F.lpad(F.floor(x["high"] / 9999 + 1).cast("string"), 2, "0"), sep,
        F.lpad((x["high"] % 9999 + 1).cast("string"), 4, "0")))
    return F.when(valid, made).otherwise(m)


def telephone(m: Column, key: str) -> Column:
    """The last ten digits (all, if there are fewer); a country code in front of them stays."""
    digits = digits_of(m)
    code = F.greatest(F.length(digits) - 10, F.lit(0))
    new = feistel_text(F.substring(digits, code + 1, F.lit(10)), key, "telephone")
    return laid_out(m, F.concat(F.substring(digits, F.lit(1), code), new))


def machine(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    new = feistel_numbers(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], 65536, 65536, key, "machine")
    return bound(new, lambda x: F.concat_ws(".", *[part.cast("string") for part in (
        F.floor(x["low"] / 256), x["low"] % 256, F.floor(x["high"] / 256), x["high"] % 256)]))


def person(m: Column, key: str) -> Column:
    """The name in front of the @ is permuted, without regard to case; the host stays."""
    name, host = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    return F.concat(feistel_text(name, key, "person"), F.lit("@"), host)


def secret(m: Column, key: str) -> Column:
    """The value behind token, password, secret or key, and access keys."""
    lead = F.regexp_extract(m, SECRET_LEAD, 1)
    value = F.substring(m, F.length(lead) + 1, F.length(m))
    hexadecimal = value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    return F.concat(lead, F.when(hexadecimal, feistel_text(value, key, "secret", 6)).otherwise(feistel_text(value, key, "secret")))


def permuted_day(year: Column, month: Column, day: Column, key: str) -> Column:
    """Another day of the same 400 years; null if there is no such day."""
    first = F.make_date(year, month, F.lit(1))
    n = F.datediff(F.make_date(year, month, day), F.lit(FIRST_DAY).cast("date"))
    new = feistel_numbers(F.floor(n / DAYS_B), n % DAYS_B, DAYS_A, DAYS_B, key, "day")
    return F.when(day <= F.dayofmonth(F.last_day(first)), bound(new, lambda x: F.date_add(
        F.lit(FIRST_DAY).cast("date"), (x["low"] * DAYS_B + x["high"]).cast("int"))))


def date_iso(m: Column, key: str) -> Column:
    year, month, day = (F.substring(m, F.lit(a), F.lit(n)).cast("int") for a, n in ((1, 4), (6, 2), (9, 2)))
    new, sep = permuted_day(year, month, day, key), F.substring(m, 5, 1)
    made = bound(new, lambda x: F.concat(F.date_format(x, "yyyy"), sep, F.date_format(x, "MM"), sep, F.date_format(x, "dd")))
    return F.coalesce(made, m)


def date_day_first(m: Column, key: str) -> Column:
    """Day, month, year; where that is no date, month, day, year."""
    parts = F.transform(F.split(m, "[./]"), lambda x: x.cast("int"))
    sep = F.regexp_extract(m, "[./]", 0)
    month_first = (parts[1] > 12) & (parts[0] <= 12)
    month = F.when(month_first, parts[0]).otherwise(parts[1])
    day = F.when(month_first, parts[1]).otherwise(parts[0])
    new = F.when(month <= 12, permuted_day(parts[2], F.least(month, F.lit(12)), day, key))
    wide = F.length(m) == 10
    two = lambda x: F.when(wide, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))

    def shown(x: Column) -> Column:
        first = F.when(month_first, two(F.month(x))).otherwise(two(F.dayofmonth(x)))
        second = F.when(month_first, two(F.dayofmonth(x))).otherwise(two(F.month(x)))
        return F.concat(first, sep, second, sep, F.date_format(x, "yyyy"))
    return F.coalesce(bound(new, shown), m)


@dataclass(frozen=True)
class Kind:
    """What stands before a value, the value itself, what stands behind it, and its pseudonym."""

    before: str
    value: str
    after: str
    pseudonym: Callable[[Column, str], Column]


OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SECRET_LEAD = r"^((?i:token|password|passwd|secret|api_?key)[\x20\t]{0,3}[=:][\x20\t]{0,3}[\x22']?|(?:AKIA|ASIA))"
KINDS = (
    Kind(r"(?<![A-Za-z0-9._%+-])", r"[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", "", person),
    Kind(r"(?<![A-Za-z0-9])", r"(?:(?i:token|password|passwd|secret|api_?key)[\x20\t]{0,3}[=:][\x20\t]{0,3}[\x22']?[A-Za-z0-9+/_-]{8,}"
         r"|(?:AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Z]))", "", secret),
    Kind(r"(?<![0-9.])", rf"(?:{OCTET}\.){{3}}{OCTET}", r"(?![0-9]|\.[0-9])", machine),
    Kind(r"(?<![0-9-])", r"(?:1[89]|2[01])[0-9]{2}([-/])(?:0[1-9]|1[0-2])[-/](?:0[1-9]|[12][0-9]|3[01])", r"(?![0-9-])", date_iso),
    Kind(r"(?<![0-9./])", r"(?:0?[1-9]|[12][0-9]|3[01])[./](?:0?[1-9]|[12][0-9]|3[01])[./](?:1[89]|2[01])[0-9]{2}",
         r"(?![0-9])", date_day_first),
    Kind(r"(?<![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)", r"(?![A-Za-z0-9])", account),
    Kind(r"(?<![0-9])", r"(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{6} [0-9]{5})",
         r"(?![0-9])", card),
    Kind(r"(?<![0-9-])", r"[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}", r"(?![0-9-])", social),
    Kind(r"(?<![A-Za-z0-9+])", r"(?:(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[1-9][0-9]{0,2}(?:[ .-]?[0-9]{2,4}){2,4})",
         r"(?![0-9])", telephone),
)
ANY = "|".join(f"{k.before}{k.value}{k.after}" for k in KINDS)


def pseudonym(m: Column, key: str) -> Column:
    made = F.when(F.lit(False), m)
    for kind in KINDS:
        made = made.when(m.rlike(f"^{kind.value}$"), kind.pseudonym(m, key))
    return made.otherwise(m)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str = "n_replaced") -> DataFrame:
    """``docs`` with the values in ``text_col`` replaced, and how many were (``count_col``, which gets
    underscores in front if the name is taken).

    One pass without shuffle; texts are processed whole.  Text around the values is unchanged, and so are
    values that fail validation (a wrong check digit, the 30th of February).  A null text stays null with
    count 0, an empty one empty; repeated rows get the same pseudonyms; an empty table gives no rows."""
    found, parts, new = (unused(docs, x) for x in ("found", "parts", "new"))
    count, text = unused(docs, count_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Few texts hold any of the characters that every kind needs.
    marked = docs.withColumn(found, F.when(text.rlike("[0-9@=:]|AKIA|ASIA"), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
                             .otherwise(F.array().cast("array<string>")))
    # A generator, so that a filter on the outcome is not moved below it and all of it repeated there.
    made = marked.select("*", F.inline(F.array(F.struct(
        F.transform(found, lambda m: pseudonym(m, key)).alias(new),
        F.when(F.size(found) > 0, F.split(text, ANY, -1)).alias(parts)))))
    woven = F.array_join(F.zip_with(parts, new, lambda p, n: F.concat(p, F.coalesce(n, F.lit("")))), "")
    replaced = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x)).cast("long")
    return made.select(
        *[F.when(F.size(found) > 0, woven).otherwise(own).alias(name) if name == text_col else own
          for name, own in zip(docs.columns, columns_of(docs), strict=True)],
        replaced.alias(count))
