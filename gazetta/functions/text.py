"""Name, province, year and date expressions (X1-X6, X22-X31): JVM columns, and one Arrow UDF for NFKC."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# What a normalised name drops, province suffixes in the order in which they are tried,
# the character that is a look-alike of 市.
DROPPED = r"(?U)[\s\x{1C}-\x{1F}\x{200B}-\x{200F}\x{2060}\x{FEFF}·•,，。.;；:：()（）\[\]【】_-]+"
PROVINCE_SUFFIXES = ["壮族自治区", "回族自治区", "维吾尔自治区", "自治区", "省", "市"]
LOOK_ALIKE = ("巿", "市")


def _compose(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition, which Spark SQL lacks. Pure ASCII is left as it is and isn't sent to Python."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, text).otherwise(F.pandas_udf(_compose, "string")(F.when(~plain, text)))


@functools.lru_cache(maxsize=4)
def _simplified(app: str) -> tuple[str, str]:
    jvm = SparkSession.getActiveSession()._jvm
    convert = jvm.com.ibm.icu.text.Transliterator.getInstance("Traditional-Simplified")
    chars = [chr(c) for c in range(0x3400, 0xA000)]
    # one call; line ends keep characters apart, as runs of them may convert as phrases
    pairs = zip(chars, convert.transliterate("\n".join(chars)).split("\n"), strict=True)
    pairs = [(a, b) for a, b in pairs if a != b and len(b) == 1]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def simplified(text: Column) -> Column:
    """Traditional to simplified characters by the ICU table on Spark's class path, as one translate()."""
    return F.translate(text, *_simplified(SparkSession.getActiveSession().sparkContext.applicationId))


def clean_text(value: Column) -> Column:
    """Text of a value, empty for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def normalize_name(value: Column, convert: bool = True) -> Column:
    """Canonical form of a name: NFKC, simplified characters, punctuation and blanks dropped; empty for null."""
    text = clean_text(value)
    if convert:
        text = simplified(nfkc(text))
    return F.trim(F.regexp_replace(F.replace(text, F.lit(LOOK_ALIKE[0]), F.lit(LOOK_ALIKE[1])), DROPPED, ""))


def strip_first_suffix(text: Column, suffixes: list[str]) -> Column:
    """text without the first of the suffixes that it ends with."""
    out = text
    for s in reversed(suffixes):
        out = F.when(F.endswith(text, F.lit(s)), F.substring(text, F.lit(1), F.length(text) - len(s))).otherwise(out)
    return out


def normalize_province(value: Column, convert: bool = True) -> Column:
    return strip_first_suffix(normalize_name(value, convert), PROVINCE_SUFFIXES)


def coerce_year(value: Column) -> Column:
    """Struct (year, bad): a blank or NaN is no year; text that is no finite number is bad; fractions are cut off."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    blank = text.isNull() | (text == "") | F.coalesce(F.isnan(number), F.lit(False))
    year = F.when(~blank & (F.abs(number) < 1e9), number.cast("int"))
    return F.struct(year.alias("year"), (~blank & year.isNull()).alias("bad"))


def approval_date(year: Column, text: Column) -> Column:
    """First M月D日 of a text as YYYY-MM-DD, without checking the calendar; empty if there is none."""
    part = lambda i: F.regexp_extract(text, "([0-9]{1,2})月([0-9]{1,2})日", i)
    date = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0"))
    return F.when(part(1) != "", date).otherwise("")


def document_number(text: Column) -> Column:
    """Number of an official letter, such as 国函〔1993〕12号; empty if there is none."""
    return F.regexp_extract(text, r"([（(〔\[]?\d{2,4}[）)〕\]]?国函(?:字)?\d+号|国函[〔\[（(]\d{4}[〕\]）)]\d+号)", 1)


def province_of_section(section: Column) -> Column:
    """What stands before the first ' / '; empty without one."""
    return F.when(F.contains(section, F.lit(" / ")), F.trim(F.split_part(section, F.lit(" / "), F.lit(1)))).otherwise("")


def source_id_of_url(url: Column, known: dict[str, str], fallback_year: Column) -> Column:
    """Registered id of a URL, else SRC-WIKI-year by the /YYYY年 in its decoded path, else by the row's year."""
    decoded = F.try_url_decode(url) if hasattr(F, "try_url_decode") else url
    year = F.regexp_extract(F.coalesce(decoded, url), "/([0-9]{4})(?:年|%E5%B9%B4)", 1)
    out = F.concat(F.lit("SRC-WIKI-"), F.when(year != "", year).otherwise(fallback_year.cast("string")))
    for u, s in sorted(known.items()):
        out = F.when(url == u, F.lit(s)).otherwise(out)
    return out


def ordered_distinct(values: Column, separators: str = r"[|、]") -> Column:
    """Distinct trimmed parts of strings that are lists themselves, in order of first appearance."""
    parts = F.flatten(F.transform(values, lambda v: F.split(F.coalesce(v, F.lit("")), separators)))
    return F.array_distinct(F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != ""))


def merge_ids(*columns: Column) -> Column:
    """Ids of several list cells, distinct in order, joined by 、."""
    return F.array_join(ordered_distinct(F.array(*columns)), "、")
