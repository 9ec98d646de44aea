"""Text functions as column expressions. All are built from Spark's own functions but ``ascii_fold``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .udfs import ascii_fold

# Patterns and lists that results depend on.
DOI_PATTERN = r"10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"
DOI_PREFIX = r"https?://(dx\.)?doi\.org/"
WORK_PATTERN = r"W([0-9]+)"
FILE_SUFFIXES = (".jpg", ".jpeg", ".png", ".tif", ".tiff", ".csv", ".xlsx", ".nc", ".mat", ".zip")
DATASET_DOI = "10.7910/"
STAGED_VERSION_TITLE = (
    r"^[A-Za-z][A-Za-z0-9_-]*\s*:\s*[A-Za-z][A-Za-z0-9_-]*\s+v?[0-9]+\.[0-9]+(\.[0-9]+)?(\s*\(.*\))?$"
    r"|^[A-Za-z][A-Za-z0-9_-]*\s+v?[0-9]+\.[0-9]+(\.[0-9]+)?(\s*\(.*\))?$"
)
GATED_VERSION_TITLE = (
    r"^[A-Za-z][A-Za-z0-9_\-]*\s+v?\d+\.\d+(\.\d+)?(\s*\(.*\))?\s*$"
    r"|^(?<name>[A-Za-z][A-Za-z0-9_\-]*)\s*:\s*\k<name>\s+v?\d+\.\d+(\.\d+)?(\s*\(.*\))?\s*$"
)
PLACEHOLDER_ABSTRACT = r"(?i)^\s*abstract\s+not\s+(provided|available)"
LEAST_ABSTRACT = 50
DOTTED = (
    (r"\bn\.v\.?", "nv"), (r"\bb\.v\.?", "bv"), (r"\bp\.l\.c\.?", "plc"), (r"\bl\.l\.c\.?", "llc"), (r"\bl\.t\.d\.?", "ltd"),
    (r"\bi\.n\.c\.?", "inc"), (r"\bc\.o\.?(?=\s|$)", "co"), (r"\ba\.g\.?(?=\s|$)", "ag"), (r"\bg\.m\.b\.h\.?", "gmbh"), (r"\bs\.r\.l\.?", "srl"),
    (r"\bs\.a\.s\.?", "sas"), (r"\bs\.a\.?(?=\s|$)", "sa"), (r"\bp\.t\.e\.?", "pte"), (r"\bp\.t\.y\.?", "pty"),
)
LEGAL_SUFFIXES = (
    "corp", "corporation", "inc", "incorporated", "ltd", "limited", "llc", "co", "company", "companies", "plc", "lp", "llp", "pte", "pty",
    "nv", "bv", "ag", "gmbh", "sa", "sas", "se", "kk", "kabushiki", "kaisha", "srl", "holding", "holdings", "group",
)
LATE_TOKEN = r"[a-zA-Z]{5,}"


def work_id(url: Column) -> Column:
    """Id of a work from its address ('' if it has none)."""
    return F.regexp_extract(url, WORK_PATTERN, 0)


def bare_doi(doi: Column) -> Column:
    """Lower-case DOI without its resolver ('' for null)."""
    # only the first resolver goes, as a DOI may quote another
    return F.lower(F.regexp_replace(F.coalesce(doi, F.lit("")), "^(.*?)" + DOI_PREFIX, "$1"))


def doi_in(citation: Column) -> Column:
    """First DOI of a citation string, lower-case, without closing marks; null if none."""
    return F.nullif(F.rtrim(F.lower(F.regexp_extract(citation, DOI_PATTERN, 0)), F.lit(".,;:")), F.lit(""))


def looks_like_file(title: Column) -> Column:
    out = F.lit(False)
    for suffix in FILE_SUFFIXES:
        out = out | F.lower(title).endswith(suffix)
    return out


def starts_with_any(value: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | value.startswith(p)
    return out


def staged_version_title(title: Column) -> Column:
    """Title of a software release: ``Name: Other v1.2`` or ``Name v1.2``."""
    return title.rlike(STAGED_VERSION_TITLE)


def gated_version_title(title: Column) -> Column:
    """The same with one name on both sides of the colon."""
    return F.trim(title).rlike(GATED_VERSION_TITLE)


def organisation_name(name: Column) -> Column:
    """Comparable form of an organisation's name; '' if there is nothing to compare.

    Dotted legal forms are joined, accents folded, marks become spaces and legal forms at the
    end go, but for a name's only word.
    """
    out = F.lower(F.coalesce(name, F.lit("")))
    for pattern, joined in DOTTED:
        out = F.regexp_replace(out, pattern, joined)
    plain = out.rlike(r"^[\x00-\x7f]*$")
    out = F.when(plain, out).otherwise(ascii_fold(out))
    out = F.trim(F.regexp_replace(F.regexp_replace(F.lower(out), "[^a-z0-9\\s]", " "), r"\s+", " "))
    return F.regexp_replace(out, r"(?<=\S)(?: (?:" + "|".join(LEGAL_SUFFIXES) + "))+$", "")


def slug(text: Column, max_tokens: int = 4) -> Column:
    """First tokens of a text as an identifier."""
    tokens = F.slice(F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " "), 1, max_tokens)
    return F.btrim(F.regexp_replace(F.array_join(tokens, "_"), "[^a-z0-9]+", "_"), F.lit("_"))


def late_tokens(text: Column) -> Column:
    """Distinct lower-case words of five letters or more."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(LATE_TOKEN), F.lit(0)), F.lower))


def token_set(text: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(text, r"\s+"), ""))


def one_contains_other(a: Column, b: Column) -> Column:
    """Whether one of two token arrays holds all of the other (a token-set score of 100); neither may be empty."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ((F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0))


def abstract_of(inverted: Column) -> Column:
    """Text of an inverted index map<word, array<position>>; gaps leave empty words, a null or empty map gives ''.

    Entries are sorted once; where words share a position the last one stands.
    """
    entries = F.flatten(F.transform(F.map_entries(inverted), lambda e: F.transform(e["value"], lambda p: F.struct(p.cast("int").alias("at"), e["key"].alias("word")))))
    placed = F.array_sort(F.filter(F.transform(entries, lambda e, i: F.struct(e["at"].alias("at"), i.alias("i"), e["word"].alias("word"))), lambda e: e["at"] >= 0))
    once = lambda value, body: F.transform(F.array(value), body)[0]
    last = once(placed, lambda s: F.filter(s, lambda x, i: ~F.coalesce(F.get(s, i + 1)["at"] == x["at"], F.lit(False))))
    text = once(last, lambda s: F.array_join(F.transform(s, lambda x, i: F.concat(F.repeat(F.lit(" "), x["at"] - F.coalesce(F.get(s, i - 1)["at"], F.lit(0))), x["word"])), ""))
    return F.coalesce(text, F.lit(""))


def cluster_name(label: Column) -> Column:
    return F.when(label < 0, F.lit("c_noise")).otherwise(F.concat(F.lit("c_"), label.cast("string")))


def link_confidence(where_found: Column) -> Column:
    return F.when(where_found.isin("front", "both"), F.lit("high")).otherwise(F.lit("medium"))


def grant_cutoff_year(max_year: Column, lag_years: Column) -> Column:
    """Last year taken for complete; halves round to even."""
    return (max_year - F.greatest(F.lit(1), F.bround(F.coalesce(lag_years, F.lit(2.0)), 0).cast("int"))).cast("int")


def role_of(papers: Column, patents: Column) -> Column:
    """What an organisation mostly does, by its patents' share of its documents."""
    share = F.coalesce(patents.cast("double") / F.nullif(papers + patents, F.lit(0)), F.lit(0.0))
    return F.when(share >= 0.7, "Primarily an IP holder").when(share <= 0.3, "Primarily a research institution").otherwise("Both researcher and IP holder")


def day_after(day: Column, years: Column) -> Column:
    """The day so many years of 365.25 days after a day, or before it; part days go down."""
    return F.date_add(day, F.floor(years * F.lit(365.25)).cast("int"))


#: Days that a trace's chart shows before the paper and after the last filing.
BEFORE, AFTER = 90, 270
#: Colours of a trust level and of the ends of the concentration scale.
TRUST_COLOURS = {"high": "#22c55e", "medium": "#94a3b8", "low": "#ef4444"}
SPREAD, CONCENTRATED = (34, 197, 94), (239, 68, 68)


def trust_colour(level: Column) -> Column:
    """Colour of a trust level; an unknown one counts as medium."""
    known = F.coalesce(*[F.when(level == k, F.lit(v)) for k, v in TRUST_COLOURS.items()])
    return F.coalesce(known, F.lit(TRUST_COLOURS["medium"]))


def concentration_colour(share: Column) -> Column:
    """Colour between the scale's ends for a share; beyond 0 and 1 the ends hold."""
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), share.cast("double")))
    part = lambda a, b: F.lpad(F.lower(F.hex((F.lit(float(a)) + F.lit(float(b - a)) * t).cast("int").cast("bigint"))), 2, "0")
    return F.when(share.isNotNull(), F.concat(F.lit("#"), *[part(a, b) for a, b in zip(SPREAD, CONCENTRATED, strict=True)]))


def cut_at_word(text: Column, limit: int) -> Column:
    """struct(snippet, cut): at most ``limit`` characters that end with a whole word, and whether any went; one longer word is cut."""
    seen = F.substring(text, 1, limit + 1)
    whole = F.when(seen.contains(" "), F.regexp_replace(seen, r"(?s) [^ ]*$", "")).otherwise(F.substring(text, 1, limit))
    long = F.length(text) > limit
    return F.struct(F.when(long, F.regexp_replace(whole, r"\s+$", "")).otherwise(text).alias("snippet"), long.alias("cut"))


def shortened(title: Column, most: int = 75) -> Column:
    return F.when(F.length(title) > most, F.concat(F.substring(title, 1, most), F.lit("…"))).otherwise(title)


# Families of documents and clusters.
PRIMARY_CODE_FAMILY = (("G03F", "euv"), ("H01S", "lasers"), ("G02B", "si_photonics"), ("G06N", "neuromorphic"), ("G11C", "in_memory"), ("H10N", "in_memory"))
TOPIC_FAMILY = (("https://openalex.org/T11338", "euv"), ("https://openalex.org/T11429", "lasers"), ("https://openalex.org/T10299", "si_photonics"))
SPLIT_TOPIC = "https://openalex.org/T10502"
SPLIT_PATTERNS = (("neuromorphic|spik|synap|neuron|brain", "neuromorphic"), ("memristor|rram|resistive|nonvolatile|phase.change|memory", "in_memory"))
CLUSTER_FAMILY = {"euv": "euv", "lasers": "silicon_photonics", "si_photonics": "silicon_photonics", "neuromorphic": "neuromorphic_in_memory", "in_memory": "neuromorphic_in_memory"}


def _first_match(cases) -> Column:
    return F.coalesce(*[F.when(test, F.lit(value)) for test, value in cases])


def patent_family(code: Column) -> Column:
    return _first_match((code.startswith(p), f) for p, f in PRIMARY_CODE_FAMILY)


def paper_family(topic: Column, title: Column, abstract: Column) -> Column:
    said = F.lower(F.concat(title, F.lit(" "), F.coalesce(abstract, F.lit(""))))
    return _first_match([*((topic == t, f) for t, f in TOPIC_FAMILY), *(((topic == SPLIT_TOPIC) & said.rlike(p), f) for p, f in SPLIT_PATTERNS)])


def patent_vote(code: Column) -> Column:
    return F.coalesce(_first_match((code.startswith(p), CLUSTER_FAMILY[f]) for p, f in PRIMARY_CODE_FAMILY), F.lit("mixed"))


def paper_vote(topic: Column) -> Column:
    return F.coalesce(_first_match([*((topic == t, CLUSTER_FAMILY[f]) for t, f in TOPIC_FAMILY), (topic == SPLIT_TOPIC, "neuromorphic_in_memory")]), F.lit("mixed"))
