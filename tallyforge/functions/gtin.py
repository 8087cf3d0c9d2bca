"""Barcode numbers and GS1 element strings: functions from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyforge.functions.text import blank_to_null, identifier_pieces, let

#: Fixed values of the GS1 standard: element strings of fixed length, by application identifier.
FIXED_LENGTHS = {"00": 18, "01": 14, "02": 14, "11": 6, "13": 6, "15": 6, "17": 6, "20": 2}
SEPARATOR = "\x1d"


def expected_digit(code: Column) -> Column:
    """The check digit that the digits before the last one call for (SC9); code has digits only."""
    body = F.reverse(F.substring(code, F.lit(1), F.length(code) - 1))
    weighted = F.transform(F.filter(F.split(body, ""), lambda d: d != ""), lambda d, i: d.try_cast("int") * F.when(i % 2 == 0, 3).otherwise(1))
    return (10 - F.aggregate(weighted, F.lit(0), lambda a, x: a + x) % 10) % 10


def digit_holds(code: Column) -> Column:
    """Whether a code of 8, 12, 13 or 14 digits ends with its check digit; false for anything else."""
    shaped = F.coalesce(code.rlike(r"^(\d{8}|\d{12,14})$"), F.lit(False))
    return F.when(shaped, F.substring(code, -1, 1).try_cast("int") == expected_digit(code)).otherwise(False)


def valid_unit(code: Column) -> Column:
    """Whether it is the code of a selling unit: 8 or 13 digits, not all zero, right check digit (SC10)."""
    return F.coalesce(F.length(code).isin(8, 13) & ~code.rlike("^0+$"), F.lit(False)) & digit_holds(code)


def clean_gtin(c: Column) -> Column:
    """Digits of a code; lost leading zeros come back, a spare one goes, where the check digit then holds (SC8)."""

    def fixed(d: Column) -> Column:
        padded = lambda n: F.lpad(d, n, "0")
        return (
            F.when(F.length(d).isin(11, 12) & digit_holds(padded(13)), padded(13))
            .when((F.length(d) == 7) & digit_holds(padded(8)), padded(8))
            .when((F.length(d) == 14) & d.startswith("0") & digit_holds(F.substring(d, 2, 13)), F.substring(d, 2, 13))
            .when(F.length(d) >= 8, d)
        )

    return let(F.regexp_replace(F.regexp_replace(c.cast("string"), r"\.0$", ""), r"\D", ""), fixed)


def diagnosis(code: Column) -> Column:
    """Why a code isn't a valid unit code, or ``ok`` (SC11)."""
    return (
        F.when(code.isNull() | (F.trim(code) == ""), "absent")
        .when(~code.rlike(r"^\d+$"), "not numeric")
        .when((F.length(code) == 14) & ~digit_holds(code), "14 digits, wrong check digit")
        .when((F.length(code) == 14) & code.startswith("0"), "14 digits, unit with leading zero")
        .when(F.length(code) == 14, "14 digits, case code")
        .when(F.length(code) == 12, "12 digits, UPC")
        .when(~F.length(code).isin(8, 13), F.concat(F.lit("length "), F.length(code).cast("string")))
        .when(~digit_holds(code), F.concat(F.lit("wrong check digit, expected "), expected_digit(code).cast("string")))
        .when(code.rlike("^0+$"), "all zeros")
        .otherwise("ok")
    )


def unit_of_gtin(code: Column) -> Column:
    """13 digits as they are, 14 with indicator 0 without it, else null; the check digit isn't looked at (SC12)."""
    return F.when(code.rlike(r"^\d{13}$"), code).when(code.rlike(r"^0\d{13}$"), F.substring(code, 2, 13))


def checked_unit(code: Column) -> Column:
    """As unit_of_gtin, null if the check digit is wrong (SC13, GS2)."""
    return let(unit_of_gtin(code), lambda u: F.when(digit_holds(u), u))


def forbidden_prefix(code: Column) -> Column:
    """Kind of a prefix that no retail product has, else null (SC43)."""
    return F.when(code.rlike("^(02|2)"), "internal use").when(code.rlike("^97[789]"), "press or book").when(code.rlike("^9[89]"), "coupon or refund")


def unit_variants(piece: Column) -> Column:
    """Provable unit codes of a piece of digits: as read, or 14 digits with a leading zero (SC36)."""
    d = F.regexp_replace(piece, r"[\s.]", "")
    return F.array_distinct(F.filter(F.array(d, unit_of_gtin(d)), lambda x: x.isNotNull() & valid_unit(x)))


def identifier_candidates(cell: Column) -> Column:
    """All provable unit codes in a cell with several identifiers, in order (SC37)."""
    return F.array_distinct(F.flatten(F.transform(identifier_pieces(cell), unit_variants)))


def structure_fault(code: Column) -> Column:
    """Level 0 of the control: fault in the shape of a code, or empty (EC1)."""
    c = F.trim(F.coalesce(code, F.lit("")))
    return (
        F.when(c == "", "no code")
        .when(~c.rlike(r"^\d+$"), "not numeric")
        .when(F.length(c) == 8, "8 digits")
        .when(F.length(c) != 13, F.concat(F.lit("length "), F.length(c).cast("string")))
        .when(~valid_unit(c), "wrong check digit")
        .otherwise(F.coalesce(forbidden_prefix(c), F.lit("")))
    )


def gs1_elements(c: Column, legacy: bool = False) -> Column:
    """Map of application identifier to value (GS1); of one that occurs twice, the last value.

    Either form is read: ``(01)...(17)...`` or raw with separators. legacy: raw strings have two-digit identifiers only, and a
    separator after a fixed-length value isn't skipped.
    """
    s = F.regexp_replace(F.trim(c), r"^\][A-Za-z]\d", "")
    pairs = lambda k, v: F.zip_with(k, v, lambda a, b: F.struct(a.alias("ai"), b.alias("value")))
    spelled = pairs(F.regexp_extract_all(s, F.lit(r"\((\d{2,4})\)([^(]*)"), F.lit(1)), F.regexp_extract_all(s, F.lit(r"\((\d{2,4})\)([^(]*)"), F.lit(2)))
    fixed = "|".join(rf"{ai}.{{{n}}}" for ai, n in FIXED_LENGTHS.items())
    if legacy:
        raw = rf"({fixed}|\d\d[^{SEPARATOR}]*{SEPARATOR}?)"
        name = F.lit(2)
    else:
        raw = rf"({fixed}|(?:2[45]\d|3\d{{3}}|4\d\d|\d\d)[^{SEPARATOR}]*){SEPARATOR}?"
        name = None

    def element(e: Column) -> Column:
        size = name if name is not None else F.when(e.rlike(r"^(2[45]|4)"), 3).when(e.startswith("3"), 4).otherwise(2)
        return F.struct(F.substring(e, F.lit(1), size).alias("ai"), F.replace(F.substring(e, size + F.lit(1), F.length(e)), F.lit(SEPARATOR), F.lit("")).alias("value"))

    read = F.transform(F.regexp_extract_all(s, F.lit(raw), F.lit(1)), element)
    chosen = F.when(s.startswith("("), spelled).otherwise(read)
    last = lambda x: F.filter(x, lambda e, i: ~F.exists(F.slice(x, i + 2, F.size(x)), lambda later: later["ai"] == e["ai"]))
    return F.map_from_entries(let(F.transform(chosen, lambda e: F.struct(e["ai"].alias("ai"), F.trim(e["value"]).alias("value"))), last))


def gs1_unit(elements: Column) -> Column:
    """Unit code of identifier 01: 14 digits with indicator 0, or 13, and a right check digit (GS2)."""
    return checked_unit(F.element_at(elements, F.lit("01")))


def gs1_date(c: Column) -> Column:
    """YYMMDD as a date: 00-49 are 2000s, day 00 is the month's last (GS3)."""
    century = F.when(F.substring(c, 1, 2).try_cast("int") < 50, "20").otherwise("19")
    first = F.try_to_timestamp(F.concat(century, F.substring(c, 1, 4), F.lit("01")), F.lit("yyyyMMdd")).cast("date")
    exact = F.try_to_timestamp(F.concat(century, c), F.lit("yyyyMMdd")).cast("date")
    return F.when(c.rlike(r"^\d{6}$"), F.when(F.substring(c, 5, 2) == "00", F.last_day(first)).otherwise(exact))


def gs1_explanation(elements: Column) -> Column:
    """``01=...; 17=2029-12-31`` with dates spelled out, by identifier (GS4)."""
    shown = lambda e: F.concat(e["key"], F.lit("="), F.when(e["key"].isin("11", "13", "15", "17"), F.coalesce(gs1_date(e["value"]).cast("string"), e["value"])).otherwise(e["value"]))
    return blank_to_null(F.array_join(F.transform(F.sort_array(F.map_entries(elements)), shown), "; "))
