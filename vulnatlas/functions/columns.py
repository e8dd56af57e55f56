"""Column expressions shared by the normalisation jobs. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as stripped from codes, tags and titles (Unicode spaces plus the
# ASCII control separators), written as the inside of a Java regex character class.
WHITESPACE = r"\s\x1c-\x1f\x85\p{Z}"

# Locations and link formats of the exploit catalogue.
MARKDOWN_DIR = "data/writeups/exploitdb"
SOURCE_DIR = "data/raw/exploitdb/files"
EXPLOIT_URL = "https://www.exploit-db.com/exploits/"
RAW_FILE_URL = "https://gitlab.com/exploit-database/exploitdb/-/raw/main/"

# Layout of the markdown card of one exploit.
CARD_FORMAT = (
    "# %1$s - %2$s\n"
    "\n"
    "- **Exploit-DB ID:** %1$s\n"
    "- **Date:** %3$s\n"
    "- **Author:** %4$s\n"
    "- **Type:** %5$s  |  **Platform:** %6$s  |  **Port:** %7$s\n"
    "- **Verified:** %8$s\n"
    "- **Tags:** %9$s\n"
    "- **CVE(s):** %10$s\n"
    "- **Local PoC file:** `%11$s`\n"
    "\n"
    "## Description\n"
    "%2$s\n"
    "\n"
    "## Source\n"
    "- Exploit-DB: %12$s\n"
    "- Raw file: %13$s\n"
)


def strip(value: Column) -> Column:
    """Both ends without any Unicode whitespace (``trim`` removes the space only)."""
    return F.regexp_replace(value, rf"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def or_empty(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def split_list(value: Column, separators: str) -> Column:
    """Stripped, non-empty parts of a delimited string; null gives an empty array."""
    parts = F.transform(F.split(or_empty(value), separators), strip)
    return F.filter(parts, lambda part: part != "")


def cve_codes(codes: Column) -> Column:
    """CVE ids among ``;``, ``|`` or ``,`` separated codes, upper-cased, duplicates kept."""
    upper = F.transform(split_list(codes, "[;|,]"), F.upper)
    return F.filter(upper, lambda code: code.startswith("CVE-"))


def slug(text: Column, width: int = 80) -> Column:
    """Lower-case ASCII words joined by ``-``, at most ``width`` characters, no outer ``-``."""
    dashed = F.regexp_replace(text, "[^a-zA-Z0-9]+", "-")
    cut = F.substring(F.lower(F.btrim(dashed, F.lit("-"))), 1, width)
    return F.rtrim(cut, F.lit("-"))


def basename(path: Column) -> Column:
    return F.substring_index(or_empty(path), "/", -1)


def file_extension(name: Column) -> Column:
    """Last suffix with its dot, lower-cased; none for dotfiles without a second dot."""
    return F.lower(F.regexp_extract(name, r"^\.*[^.].*(\.[^.]*)$", 1))


def text_title(text: Column) -> Column:
    """First non-blank line: the rest after ``# ``, otherwise its first 120 characters."""
    line = strip(F.regexp_extract(text, rf"\A[{WHITESPACE}]*([^\n\r]*)", 1))
    heading = strip(F.substr(line, F.lit(3)))
    return F.when(line.startswith("# "), heading).otherwise(F.substring(line, 1, 120))


def first_value_in_language(descriptions: Column, lang: str = "en") -> Column:
    matching = F.filter(descriptions, lambda d: d["lang"] == lang)
    return or_empty(F.get(matching, 0)["value"])


def preferred_metric(metrics: Column, precedence: tuple[str, ...]) -> Column:
    """First element of the first non-empty metric array, whatever that element holds."""
    return F.coalesce(
        *(F.when(F.size(metrics[name]) > 0, F.get(metrics[name], 0)) for name in precedence)
    )


def metric_severity(metric: Column) -> Column:
    return F.coalesce(F.nullif(metric["baseSeverity"], F.lit("")), metric["cvssData"]["baseSeverity"])


def first_cwe(weaknesses: Column) -> Column:
    per_weakness = F.transform(weaknesses, lambda w: F.coalesce(w["description"], F.array()))
    values = F.transform(F.flatten(per_weakness), lambda d: d["value"])
    return F.get(F.filter(values, lambda v: v.startswith("CWE-")), 0)


def reference_urls(references: Column) -> Column:
    urls = F.transform(references, lambda r: or_empty(r["url"]))
    return F.coalesce(urls, F.array().cast("array<string>"))


def reference_tags(references: Column) -> Column:
    """Distinct tags of all references in first-seen order."""
    tags = F.flatten(F.transform(references, lambda r: F.coalesce(r["tags"], F.array())))
    return F.coalesce(F.array_distinct(tags), F.array().cast("array<string>"))


def published_year(published: Column) -> Column:
    return F.substring(published, 1, 4)


def json_array(text: Column) -> Column:
    """A JSON list of strings as an array; null or empty text gives an empty array."""
    return F.coalesce(F.from_json(F.nullif(text, F.lit("")), "array<string>"), F.array().cast("array<string>"))


def json_row(columns: list[str]) -> Column:
    """One JSON object of the given columns, nulls written out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
