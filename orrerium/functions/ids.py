"""Identifiers of datasets, publications and people, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a DOI and an EMDB accession look like.
DOI = r"(?U)10\.\d{4,9}/[^\s\"'<>\]]+"
EMDB = r"(?i)EMD-\d{4,5}"
DOI_URL = "https://doi.org/"
ORCID = r"^\d{4}-\d{4}-\d{4}-\d{4}$"
#: What counts as white space at the ends of a text.
WHITE = " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
DASHES = r"[\u2010\u2011\u2012\u2013\u2014\u2015\u2212]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Column, then) -> Column:
    """then(c), with c evaluated once however often it is used."""
    return F.get(F.transform(F.array(c), then), F.lit(0))


def stripped(c) -> Column:
    """Without white space of any kind at either end."""
    return F.trim(_col(c), F.lit(WHITE))


def percent_decoded(c) -> Column:
    """%XX as UTF-8; a plus sign and a malformed escape stay."""
    c = _col(c)
    safe = F.regexp_replace(F.replace(c, F.lit("+"), F.lit("%2B")), r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(c.contains("%"), F.coalesce(F.try_url_decode(safe), c)).otherwise(c)


def norm_doi(c) -> Column:
    """The first DOI in a text, decoded and in lower case, without signs that end a sentence; empty if there is none."""
    found = F.regexp_extract(F.lower(percent_decoded(stripped(c))), DOI, 0)
    return F.coalesce(F.rtrim(found, F.lit(".,;:)]")), F.lit(""))


def norm_doi_url(c) -> Column:
    return let(norm_doi(c), lambda doi: F.when(doi != "", F.concat(F.lit(DOI_URL), doi)).otherwise(F.lit("")))


def doi_url_or_raw(c) -> Column:
    """The DOI as an address, or else the text as it is; null stays null."""
    return let(norm_doi(c), lambda doi: F.when(doi != "", F.concat(F.lit(DOI_URL), doi)).otherwise(_col(c)))


def norm_emdb(c) -> Column:
    return F.coalesce(F.upper(F.regexp_extract(_col(c), EMDB, 0)), F.lit(""))


def norm_dataset_id(c) -> Column:
    """A DOI, or else an EMDB accession, or else the text in lower case without outer white space; empty for null."""
    other = let(norm_emdb(c), lambda emdb: F.when(emdb != "", emdb).otherwise(F.coalesce(F.lower(stripped(c)), F.lit(""))))
    return let(norm_doi(c), lambda doi: F.when(doi != "", doi).otherwise(other))


def norm_dataset_id_or_null(c) -> Column:
    return F.when(_col(c).isNotNull(), norm_dataset_id(c))


def norm_orcid(c) -> Column:
    """Four groups of four digits, from an address or with other dashes; null otherwise."""
    bare = F.regexp_replace(F.regexp_replace(stripped(c), r"(?i)^(https?://)?(www\.)?orcid\.org/|^orcid:\s*", ""), DASHES, "-")
    return F.when(bare.rlike(ORCID), bare)


def creator_identifier(c) -> Column:
    """What follows orcid.org/ or a leading orcid:, else all; trimmed, in lower case."""
    c = _col(c)
    part = F.when(c.contains("orcid.org/"), F.get(F.split(c, r"orcid\.org/"), F.lit(1))).when(c.startswith("orcid:"), F.get(F.split(c, "orcid:"), F.lit(1))).otherwise(c)
    return F.lower(F.trim(part))


def last_segment(c) -> Column:
    """What follows the last slash; null for null or empty."""
    return F.when(_col(c) != "", F.substring_index(_col(c), "/", -1))


def clean_link(c) -> Column:
    """Without fragment, then slashes at the end, then outer blanks."""
    return stripped(F.rtrim(F.substring_index(_col(c), "#", 1), F.lit("/")))


def is_url(c) -> Column:
    """An http or https address with a host."""
    return F.coalesce(F.lower(F.try_parse_url(_col(c), F.lit("PROTOCOL"))).isin("http", "https") & (F.coalesce(F.try_parse_url(_col(c), F.lit("HOST")), F.lit("")) != ""), F.lit(False))


def topic_id(c) -> Column:
    """T and the digits of the last segment; null without digits."""
    digits = F.regexp_replace(F.substring_index(_col(c), "/", -1), r"\D", "")
    return F.when(digits != "", F.concat(F.lit("T"), digits))


def unique_pairs(c) -> Column:
    """Distinct (identifier, type) of an array of structs, types in lower case, in order of appearance."""
    kept = F.filter(_col(c), lambda x: F.coalesce(x["identifier"], F.lit("")) != "")
    return F.array_distinct(F.transform(kept, lambda x: F.struct(x["identifier"].alias("identifier"), F.lower(x["identifier_type"]).alias("identifier_type"))))


def preferred_identifier(c, *kinds: str) -> Column:
    """The first identifier of the first kind that there is, else the first of all."""
    c = _col(c)

    def first(kind: str) -> Column:
        return F.get(F.filter(c, lambda x: x["identifier_type"] == kind), F.lit(0))

    return F.coalesce(*map(first, kinds), F.get(c, F.lit(0)))


def reachable(head, get, allow_blocked: bool = False) -> Column:
    """Whether recorded answers show that a link works: the status of a HEAD request or, where the server refuses that kind
    or fails, of a GET request. Success and redirection do; 401 and 403 do if `allow_blocked`. No answer is none."""
    head, get = _col(head), _col(get)
    status = F.when(head.isin(405, 501) | head.between(500, 599), get).otherwise(head)
    works = status.between(200, 399) | (F.lit(allow_blocked) & status.isin(401, 403))
    return F.coalesce(works, F.lit(False))
