"""Identifiers and control signs in free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import let, percent_decoded

#: The five ways that a README names a DOI, and an EMDB accession.
README_DOIS = (
    (r"(?i)\[.*?\]\((?:https?://)?(?:dx\.)?doi\.org/(10\.\d{4,}/[^\s\[\]]+)\)", 1),
    (r"(?i)doi:\s*(10\.\d{4,}/[^\s\[\]\<\>]+)", 1),
    (r"(?i)(?:https?://)?(?:dx\.)?doi\.org/(10\.\d{4,}/[^\s\[\]\<\>]+)", 1),
    (r"(?<![a-zA-Z:/])10\.\d{4,}/[^\s\[\]\<\>]+", 0),
)
FREE_DOI = r"(?i)10\.\d{4,9}/[-._;()/:a-z0-9]+"
README_EMDB = r"\bEMD-\d{4,5}\b"
#: File names that count as a README of a repository's root.
READMES = ("readme", "readme.md", "readme.txt", "readme.rst", "readme.markdown", "readme.adoc")
BRACKETS = (("(", ")"), ("{", "}"), ("[", "]"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _all(c, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(pattern), F.lit(group))


def dois_in(c) -> Column:
    """Sorted distinct DOIs in a text, in lower case, without a stop or comma at the end."""
    return F.array_sort(F.array_distinct(F.transform(_all(c, FREE_DOI, 0), lambda x: F.regexp_replace(F.lower(x), "[.,]+$", ""))))


def emdb_in(c) -> Column:
    return F.array_sort(F.array_distinct(F.transform(_all(c, r"(?i)\bEMD-\d{4,5}\b", 0), lambda x: F.upper(x))))


def balanced(c: Column, brackets=BRACKETS) -> Column:
    """Drops brackets at the end as long as there are more of them than of their counterparts.

    What may go is a run of one sign at the end, so that the number to drop is the least of the run and the surplus.
    """
    count = lambda x, sign: F.length(x) - F.length(F.replace(x, F.lit(sign), F.lit("")))

    def drop(last: str, other: str):
        run = lambda x: F.length(F.regexp_extract(x, f"\\{last}*$", 0))
        return lambda x: F.substring(x, F.lit(1), F.length(x) - F.greatest(F.least(run(x), count(x, last) - count(x, other)), F.lit(0)))

    for opening, closing in brackets:
        c = let(let(c, drop(closing, opening)), drop(opening, closing))
    return c


def clean_doi(c) -> Column:
    """Without address or doi: in front and signs behind, and with brackets balanced."""
    bare = F.regexp_replace(F.regexp_replace(_col(c), r"(?i)^(https?://)?(dx\.)?doi\.org/", ""), r"(?i)^doi:\s*", "")
    return balanced(F.regexp_replace(bare, r"[.,;:?!\s\"'\\*<>]+$", ""))


def readme_dois(c) -> Column:
    """Sorted distinct cleaned DOIs that any of the README patterns finds."""
    found = F.concat(*[_all(c, pattern, group) for pattern, group in README_DOIS])
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, clean_doi), lambda x: x != "")))


def readme_emdb(c) -> Column:
    return F.array_sort(F.array_distinct(_all(c, README_EMDB, 0)))


#: What may follow a DOI in a README without being part of it, in the order in which it is removed.
SUFFIXES = (
    r"(?i)\.(https?|url).*$",
    r"(?i)\(https?:.*$",
    r"(?i)https?:/+.*$",
    r"[?#\";&].*$",
    r"(?i)\.(svg|png|jpg|jpeg|pdf|html?|epdf|zip|short|status|docx|java|exe|msi|dmg|apk)$",
    r"(?i)-[a-z]{4,20}$",
    r"[.,:?!\s\"'\\*`/>}\)\]_]+$",
    r"(?i)\.abstract$",
    r"(?i)abstract$",
    r"(?i)(data|this|that|here|info|click|link)$",
    r"(?i)/(full|fulltext|html)(/html)?$",
    r"(?i)/(attachment|supplementary|media|content|mmc\d+|supporting_information)(/.*)?$",
    r"(?i)\.full-text$",
    r"(?i)\.full$",
    r"\.$",
)
WEB_PARTS = (
    "abstract", "full", "download", "supplementary", "epdf", "meta", "title", "references", "introduction", "methods", "results", "figures", "tables", "pdf", "summary",
    "asset", "graphic", "assets", "binary", "luennot-files", "src", "main", "java", "com", "google", "android",
)
WEB_PATTERN = r"^abstract\d+$|^[a-z\-]+-\d{10,}|^(qo_|advances_)|supplementary|template|^[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}$|^acrefore-|^oso-|^\d{7,}$"
NO_PART = r"bluestacks|_native\.exe|\.exe"
NO_DOI = r"microsoft\.azure|2020/01/04|^10\.6220/2014_reverse|^10\.19420/play-services"
VALID_DOI = r"^10\.\d{4,9}/[a-z0-9().:_;\-/<>]+$"


def readme_doi_cleaned(c) -> Column:
    """One DOI as a README writes it, brought to the form that registries use; null if nothing valid remains."""
    raw = F.regexp_replace(F.trim(percent_decoded(c)), r"\\", "")
    raw = F.translate(raw, "\u201c\u201d\u2018\u2019", "\"\"''")
    each = _all(raw, r"10\.\d{4,9}/[^\s\"'\[\]\<\>]+", 0)
    doi = F.regexp_replace(F.coalesce(F.try_element_at(each, F.lit(-1)), raw), r"(?i)^https?://(dx\.)?doi\.org/", "")
    for pattern in SUFFIXES:
        doi = F.regexp_replace(doi, pattern, "")
    doi = F.lower(F.trim(F.regexp_replace(balanced(doi, (*BRACKETS, ("<", ">"))), r"^[\[\(\{\"'<\s_]+", "")))
    special = lambda x: x.startswith("10.1101/") | x.startswith("10.22541/")
    doi = let(doi, lambda x: F.when(special(x), F.regexp_replace(F.regexp_replace(x, r"\.(abstract|full|pdf)$", ""), r"\.supplementary.*$", "")).otherwise(x))
    parts = F.filter(F.split(doi, "/"), lambda p: (p != "") & ~p.rlike(NO_PART))
    trash = lambda p: p.isin(*WEB_PARTS) | p.rlike(WEB_PATTERN) | ((F.length(p) > 40) & p.contains("-"))
    # Parts go from the end while they are trash and more than two are left: up to the last part that isn't trash.
    good = lambda ps: F.coalesce(F.array_max(F.transform(ps, lambda p, i: F.when(~trash(p) | (i < 2), i + 1).otherwise(0))), F.lit(0))
    parts = let(parts, lambda ps: F.slice(ps, F.lit(1), good(ps)))
    part = lambda ps, i: F.coalesce(F.get(ps, F.lit(i)), F.lit(""))
    short = lambda ps: ((F.size(ps) >= 4) & part(ps, 2).rlike(r"^\d{5,}$")) | ((F.size(ps) == 5) & (part(ps, 2) == part(ps, 4)) & part(ps, 3).rlike(r"^\d+$"))
    doi = let(parts, lambda ps: F.array_join(F.when(short(ps), F.slice(ps, 1, 3)).otherwise(ps), "/"))
    dots = lambda x: F.length(x) - F.length(F.replace(x, F.lit("."), F.lit("")))
    return let(doi, lambda x: F.when((dots(x) <= 10) & ~x.rlike(NO_DOI) & x.rlike(VALID_DOI) & (F.length(x) >= 9), x))


def without_control(c) -> Column:
    """Without control characters and replacement signs."""
    return F.regexp_replace(_col(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F\uFFFD]", "")


def affiliation_list(c) -> Column:
    """The parts between commas of an array's JSON text without brackets, quotes and backslashes, trimmed; null for null."""
    return F.transform(F.split(F.regexp_replace(_col(c), r"[\[\]\"\\]", ""), ","), lambda x: F.trim(x))


def is_root_readme(path) -> Column:
    return F.coalesce(~_col(path).contains("/") & F.lower(_col(path)).isin(*READMES), F.lit(False))
