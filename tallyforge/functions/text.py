"""Cleaning of text, identifiers, numbers and dates: functions from Column to Column."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters with marks and what they fold to, in two strings of one length.
_MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿĀāĂăĄąĆćĈĉĊċČčĎďĒēĔĕĖėĘęĚěĜĝĞğĠġĢģĤĥĨĩĪīĬĭĮįĴĵĶķĹĺĻļĽľŃńŅņŇňŌōŎŏŐőŔŕŖŗŘřŚśŜŝŞşŠšŢţŤťŨũŪūŬŭŮůŰűŲųŴŵŶŷŸŹźŻżŽž"


def _folded() -> str:
    import unicodedata

    return "".join(unicodedata.normalize("NFD", c)[0] for c in _MARKED)


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_text(c: Column) -> Column:
    """Trimmed, any run of white space (no-break spaces too) as one space, empty as null (SC1, SC7)."""
    return blank_to_null(F.trim(F.regexp_replace(c.cast("string"), r"(?U)\s+", " ")))


def number_text(c: Column) -> Column:
    """Text of a number: a whole double without its fraction (SC1)."""
    return F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))


def without_invisible(c: Column) -> Column:
    """Format characters (soft hyphens, zero-width and direction marks) removed (SC3)."""
    return F.regexp_replace(c, r"\p{Cf}", "")


def clean_line(c: Column) -> Column:
    """Text of an acknowledgement: without invisible characters, trimmed, never null (SC2)."""
    return F.coalesce(clean_text(without_invisible(c)), F.lit(""))


def clean_number(c: Column) -> Column:
    """A double from text with spaces, currency or comma; ``%`` divides by 100; null where it can't be read (SC4, SC6)."""
    digits = F.regexp_replace(F.replace(c, F.lit(","), F.lit(".")), r"[^0-9.\-]", "")
    value = digits.try_cast("double")
    return F.when(F.contains(c, F.lit("%")), value / 100).otherwise(value)


def plain_number(c: Column) -> Column:
    """As clean_number for acknowledgements, where ``%`` means nothing (SC5)."""
    return F.regexp_replace(F.replace(without_invisible(c), F.lit(","), F.lit(".")), r"[^0-9.\-]", "").try_cast("double")


def fold_accents(c: Column) -> Column:
    """Letters without marks: composed Latin letters by table, loose marks removed (SC22 to SC27)."""
    return F.regexp_replace(F.translate(c, _MARKED, _folded()), r"\p{M}", "")


def heading_key(c: Column) -> Column:
    """Lower-case letters and digits of a heading, null as empty (SC22 to SC25)."""
    return F.regexp_replace(F.lower(fold_accents(F.coalesce(c, F.lit("")))), "[^a-z0-9]", "")


def upper_plain(c: Column) -> Column:
    """Upper-case without accents (SC26, SC29)."""
    return F.upper(fold_accents(c))


def upper_words(c: Column) -> Column:
    """Upper-case words without accents, other characters as spaces (SC27)."""
    return F.regexp_replace(upper_plain(F.coalesce(c, F.lit(""))), "[^A-Z0-9]+", " ")


def label_words(c: Column) -> Column:
    """As upper_words, but apostrophes vanish so that ``X'S`` stays one word (SC28)."""
    return F.trim(F.regexp_replace(F.regexp_replace(upper_plain(F.coalesce(c, F.lit(""))), "['’]", ""), "[^A-Z0-9]+", " "))


def flat_name(c: Column) -> Column:
    """Upper-case letters and digits only (SC30)."""
    return F.regexp_replace(upper_plain(F.coalesce(c, F.lit(""))), "[^A-Z0-9]", "")


def filled(c: Column) -> Column:
    """Trimmed text; null and ``nan`` are empty (SC31)."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(F.lower(t) == "nan", "").otherwise(t)


def strict_ref(c: Column) -> Column:
    """Reference key: upper-case without spaces and without a trailing ``.0`` (SC14)."""
    return blank_to_null(F.regexp_replace(F.replace(F.upper(clean_text(c)), F.lit(" "), F.lit("")), r"\.0$", ""))


def loose_ref(c: Column) -> Column:
    """The strict key without ``. - _ /`` (SC15)."""
    return blank_to_null(F.translate(strict_ref(c), ".-_/", ""))


def internal_ref(c: Column) -> Column:
    """Internal reference: no leading slash, single spaces, upper-case; signs of absence are null (SC16)."""
    t = F.upper(clean_text(F.regexp_replace(F.trim(c), "^/+", "")))
    return F.when(~t.isin("NAN", "NONE", "-"), t)


def item_code(c: Column) -> Column:
    """Item code without the ``.0`` that a detour through doubles leaves; ``nan`` and empty are null (SC17 to SC19)."""
    t = F.regexp_replace(F.regexp_replace(F.trim(c), r"\.0$", ""), "^/+", "")
    return F.when((t != "") & (F.lower(t) != "nan"), t)


def supplier_key(c: Column) -> Column:
    """Supplier name: upper-case, other than A-Z and 0-9 as one space (SC20)."""
    return blank_to_null(F.trim(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", " ")))


def tier_number(c: Column) -> Column:
    """A tier as a double; null isn't 1 (SC21)."""
    return c.cast("string").try_cast("double")


def type_code(c: Column) -> Column:
    """What stands before the first hyphen, upper-case (SC32)."""
    return F.upper(F.trim(F.get(F.split(c, "-"), F.lit(0))))


def after_hyphen(c: Column) -> Column:
    """The name in ``id - name`` (SC33)."""
    return F.trim(F.regexp_replace(c, r"^[^-]*-", ""))


def reference_stem(c: Column) -> Column:
    """First run of six digits or more (SC34)."""
    return blank_to_null(F.regexp_extract(c, r"(\d{6,})", 1))


def identifier_pieces(c: Column) -> Column:
    """Pieces of a cell with several identifiers, cut at ``+`` and wide gaps (SC35)."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), r"\s*\+\s*|\s{2,}"), lambda p: F.trim(p)), lambda p: p != "")


def usable_manufacturer_ref(c: Column, not_references: tuple[str, ...] = ("SELON", "VOIR", "N/A", "SUR DEMANDE")) -> Column:
    """The reference if it has four characters or more and is neither a date nor free text (SC38)."""
    t = clean_text(c)
    free = functools.reduce(operator.or_, [F.upper(t).startswith(x) for x in not_references], F.lit(False))
    return F.when((F.length(t) >= 4) & ~t.rlike(r"^\d{1,4}[-/]\d{1,2}[-/]\d{1,4}") & ~free, t)


def reference_with_origin(supplier_ref: Column, manufacturer_ref: Column) -> Column:
    """Struct of the reference to use and where it comes from (SC39)."""
    own, other = clean_text(supplier_ref), usable_manufacturer_ref(manufacturer_ref)
    return F.struct(F.coalesce(own, other).alias("ref"), F.when(own.isNotNull(), "supplier").when(other.isNotNull(), "manufacturer").alias("ref_origin"))


def reliable_ref(c: Column, least: int = 9) -> Column:
    """Long enough to be worth a query; never null (SC41)."""
    return F.coalesce(F.length(F.trim(c)) >= least, F.lit(False))


def queryable_ref(c: Column, origin: Column, least: int = 9) -> Column:
    """Reliable, and digits if it is the manufacturer's (SC40)."""
    return reliable_ref(c, least) & ((origin != "manufacturer") | F.trim(c).rlike(r"^[\d .\-/]+$"))


def doubtful_link(source: Column, ref: Column, least: int = 9) -> Column:
    """A registry link made by a short reference; never null (SC42)."""
    return F.coalesce(source == "registry", F.lit(False)) & ~reliable_ref(ref, least)


def english_date(c: Column) -> Column:
    """``18-SEP-26`` as a date of this century, null where it isn't one (SC44)."""
    return F.to_date(F.try_to_timestamp(F.initcap(F.trim(c)), F.lit("dd-MMM-yy")))


def first_group(c: Column, pattern: str) -> Column:
    """First group of the first match, or empty (SC45)."""
    return F.coalesce(F.regexp_extract(c, pattern, 1), F.lit(""))


def comma_percent(c: Column) -> Column:
    """A share as ``12,3 %`` (SC46)."""
    return F.replace(F.format_string("%.1f %%", c * 100), F.lit("."), F.lit(","))


def file_name(c: Column, words: int = 4, length: int = 60) -> Column:
    """A safe name of up to ``words`` identifying words (IO34)."""
    named = F.filter(F.split(label_words(c), " "), lambda w: F.length(w) > 2)
    return F.substring(F.array_join(F.slice(named, 1, words), "_"), 1, length)
