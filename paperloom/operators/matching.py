"""Entity resolution and citation matching as joins and windows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import late_tokens, link_confidence, one_contains_other, organisation_name, slug, token_set
from ..functions.udfs import token_set_ratio
from ..session import materialise
from .relational import first_per_key, semi

# Fixed values.
MOST_POSTINGS, MOST_CANDIDATES, LEAST_TITLE_WORDS, LEAST_REFERENCE = 5000, 30, 5, 40
THRESHOLDS, LEAST_PRECISION = (90, 95, 100), 0.80
ORGANISATION_TYPES = ("2", "3", "6", "7")


def patent_side_organisations(assignees: DataFrame, scoped: DataFrame) -> DataFrame:
    """(assignee_id, display_name, normalized_name, match_method, confidence) of organisations in scope."""
    own = semi(assignees.where(F.col("assignee_type").isin(*ORGANISATION_TYPES) & (F.trim("disambig_assignee_organization") != "")), scoped, "patent_id")
    named = own.groupBy("assignee_id").agg(F.min("disambig_assignee_organization").alias("display_name"))
    return _normalised(named, "native_id")


def paper_side_organisations(works: DataFrame) -> DataFrame:
    """(institution_id, display_name, normalized_name, match_method, confidence); ids and names are paired by place."""
    pairs = works.select(F.explode(F.arrays_zip("institution_ids", "institution_display_names")).alias("p")).select(F.col("p.institution_ids").alias("institution_id"), F.col("p.institution_display_names").alias("name"))
    named = pairs.where("institution_id is not null and name is not null").groupBy("institution_id").agg(F.min("name").alias("display_name"))
    return _normalised(named, "ror")


def _normalised(named: DataFrame, method: str) -> DataFrame:
    out = named.withColumn("normalized_name", organisation_name(F.col("display_name"))).where("normalized_name <> ''")
    return out.withColumn("match_method", F.lit(method)).withColumn("confidence", F.lit("high"))


def seed_matches(seed: DataFrame, staged: DataFrame) -> DataFrame:
    """Seed organisations found by normalised name on the patent side."""
    own = seed.select("org_id", "canonical_name", F.col("normalized_patentsview").alias("normalized_name")).distinct()
    return staged.select("assignee_id", "display_name", "normalized_name").join(own, "normalized_name").select("org_id", "canonical_name", "assignee_id", "display_name", F.lit("seed_crosswalk").alias("match_method"), F.lit("high").alias("confidence"))


def seed_unmatched(seed: DataFrame, staged: DataFrame) -> DataFrame:
    return seed.join(staged.select(F.col("normalized_name").alias("normalized_patentsview")), "normalized_patentsview", "left_anti")


def seed_institutions(seed: DataFrame, staged: DataFrame) -> DataFrame:
    """Seed organisations found by an explicit institution id."""
    own = seed.where(F.trim("openalex_institution_id") != "").select("org_id", "canonical_name", F.col("openalex_institution_id").alias("institution_id")).distinct()
    return staged.select("institution_id", "display_name").join(own, "institution_id").select("org_id", "canonical_name", "institution_id", "display_name", F.lit("seed_crosswalk").alias("match_method"), F.lit("high").alias("confidence"))


_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def _named(df: DataFrame, name: str, key: str) -> DataFrame:
    """Distinct names with their first word, tokens, length of the tokens joined and counts of letters."""
    known = df.where(F.col(name) != "").select(F.col(name).alias(key)).distinct()
    joined = F.array_join(F.array_sort("t"), " ")
    bag = F.transform(F.array(*[F.lit(x) for x in _LETTERS]), lambda x: F.length("j") - F.length(F.replace(F.col("j"), x, F.lit(""))))
    out = known.select(key, F.substring_index(key, " ", 1).alias("first"), token_set(F.col(key)).alias("t")).withColumn("j", joined)
    # all other characters count as one kind
    bag = F.concat(bag, F.array(F.length(F.translate("j", _LETTERS, ""))))
    return out.select(key, "first", F.col("t").alias(f"t{key}"), F.length("j").alias(f"n{key}"), bag.alias(f"bag{key}"))


def _containing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs (a, b) of names with one first word of which one holds all tokens of the other.

    The name that is contained has its rarest token in the other, so names of several tokens meet on the rarest token of either. A name of one token is its block's
    first word: it meets the block's names by that, and of those it is contained in one row a block is enough (least ``rid``).
    """
    alone = lambda k: (F.size(f"t{k}") == 1) & (F.get(f"t{k}", F.lit(0)) == F.col("first"))
    many = {k: df.where(~alone(k)) for k, df in (("a", a), ("b", b))}
    held = {k: df.select("*", F.explode(f"t{k}").alias("token")) for k, df in many.items()}
    counts = held["a"].select("token").unionByName(held["b"].select("token")).groupBy("token").agg(F.count("*").alias("n"))
    rare = {k: h.join(counts, "token").groupBy(k, "first").agg(F.min(F.struct("n", "token")).alias("r"), F.first(f"t{k}").alias(f"t{k}")).select(k, "first", f"t{k}", F.col("r.token").alias("token")) for k, h in held.items()}
    keys = ["first", "token"]
    met = rare["a"].join(held["b"].select("b", "tb", *keys), keys).unionByName(held["a"].select("a", "ta", *keys).join(rare["b"], keys), allowMissingColumns=True)
    pairs = met.select("a", "b", "ta", "tb").where(one_contains_other(F.col("ta"), F.col("tb"))).select("a", "b").distinct()
    least = b.groupBy("first").agg(F.min(F.struct("rid", "b")).alias("x")).select("first", F.col("x.b").alias("b"))
    short_a = a.where(alone("a")).select("a", "first").join(least, "first").select("a", "b")
    short_b = many["a"].select("a", "first").join(b.where(alone("b")).groupBy("first").agg(F.min(F.struct("rid", "b")).alias("x")).select("first", F.col("x.b").alias("b")), "first").select("a", "b")
    return pairs.unionByName(short_a).unionByName(short_b)


def _common(x: Column, y: Column) -> Column:
    """Letters that two counts of letters have in common: no common subsequence is longer."""
    return F.aggregate(F.zip_with(x, y, lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v)


def similar_candidates(a: DataFrame, b: DataFrame, review: float) -> DataFrame:
    """Pairs of names with one first word that may score ``review`` or more: (a, b, sure, bound).

    A token-set score is the best of three. Two compare what the names share with one of them: they are known from lengths (``sure``), and reach ``review`` only if the shared tokens
    make up so much of a name that one of its rarer tokens is among them. The third compares the names themselves: lengths and counts of letters
    bound it (``bound``). No name is scored here.
    """
    part = review / (200.0 - review)
    tokens = {k: df.select(k, "first", f"n{k}", F.explode(f"t{k}").alias("token")) for k, df in (("a", a), ("b", b))}
    counts = tokens["a"].select("token").unionByName(tokens["b"].select("token")).groupBy("token").agg(F.count("*").alias("n"))
    keys, met = ["first", "token"], []
    early = {}
    for k in "ab":
        order = tokens[k].join(counts, "token").groupBy(k, "first", f"n{k}").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("s"))
        rest = F.transform("s", lambda x, i: F.struct(x["token"].alias("token"), F.aggregate(F.slice("s", i + 1, F.size("s")), F.lit(0), lambda w, y: w + F.length(y["token"]) + 1).alias("rest")))
        early[k] = order.select(k, "first", F.col(f"n{k}").alias("n"), F.explode(rest).alias("x")).where(F.col("x.rest") >= part * F.col("n") + 1 - 1e-6).select(k, "first", F.col("x.token").alias("token"))
    met.append(early["a"].join(tokens["b"].select("b", *keys), keys).select("a", "b"))
    met.append(tokens["a"].select("a", *keys).join(early["b"], keys).select("a", "b"))
    step = -math.log(part)
    grade = lambda n: F.floor(F.log(F.col(n)) / step).cast("int")
    left = a.select("a", "first", "na", "baga", F.explode(F.sequence(grade("na") - 1, grade("na") + 1)).alias("grade"))
    near = left.join(b.select("b", "first", "nb", "bagb", grade("nb").alias("grade")), ["first", "grade"])
    short = F.least("na", "nb") * 200.0 >= review * (F.col("na") + F.col("nb")) - 1e-6
    met.append(near.where(short).where(_common(F.col("baga"), F.col("bagb")) * 200.0 >= review * (F.col("na") + F.col("nb")) - 1e-6).select("a", "b"))
    pairs = met[0].unionByName(met[1]).unionByName(met[2]).distinct().join(a.drop("first"), "a").join(b.drop("first", "rid"), "b")
    shared = F.length(F.array_join(F.array_intersect("ta", "tb"), " "))
    known = pairs.withColumn("s", shared)
    sure = F.greatest(F.lit(200.0) * F.col("s") / (F.col("s") + F.col("na")), F.lit(200.0) * F.col("s") / (F.col("s") + F.col("nb")))
    bound = F.lit(200.0) * F.least("na", "nb", _common(F.col("baga"), F.col("bagb"))) / (F.col("na") + F.col("nb"))
    return known.select("a", "b", sure.alias("sure"), bound.alias("bound")).where(F.greatest("sure", "bound") >= review)


def blocked_bridge(left: DataFrame, right: DataFrame, left_id: str = "institution_id", right_id: str = "assignee_id", name: str = "normalized_name", high: float = 100, review: float = 100) -> DataFrame:
    """Best match of each left name among right names with its first word: the highest token-set score, then the least right id.

    A score of 100 is a containment test on token arrays, with no Python in the plan. Below 100, names without such a match meet by ``similar_candidates``; a
    pair is scored only if its bound reaches ``review`` and the best score that is sure for its left name. Names are compared once, however many rows have them.
    """
    # both are read several times
    a = materialise(_named(left, name, "a"))
    ids = right.where(F.col(name) != "").groupBy(F.col(name).alias("b")).agg(F.min(right_id).alias("rid"))
    b = materialise(_named(right, name, "b").join(ids, "b"))
    ids = b.select("b", "rid")
    found = _containing(a, b).withColumn("similarity", F.lit(100.0))
    if review < 100:
        found = materialise(found)
        pairs = materialise(similar_candidates(a.join(found.select("a"), "a", "left_anti"), b, review))
        floor = pairs.groupBy("a").agg(F.max("sure").alias("floor"))
        open_ = pairs.join(floor, "a").where(F.greatest("sure", "bound") >= F.col("floor"))
        known = open_.where("bound <= sure").select("a", "b", F.col("sure").alias("similarity"))
        scored = open_.where("bound > sure").select("a", "b", token_set_ratio("a", "b").alias("similarity"))
        found = found.unionByName(known.unionByName(scored).where(F.col("similarity") >= review))
    best = first_per_key(found.join(ids, "b"), "a", [F.col("similarity").desc(), F.col("rid")])
    rows = left.where(F.col(name) != "").select(left_id, F.col(name).alias("a")).join(best.select("a", F.col("rid").alias(right_id), "similarity"), "a")
    rows = first_per_key(rows, left_id, [F.col("similarity").desc(), F.col(right_id)])
    sure = F.col("similarity") >= high
    return rows.select(left_id, right_id, "similarity", F.when(sure, "fuzzy_high").otherwise("fuzzy_review").alias("match_method"), F.when(sure, "high").otherwise("medium").alias("confidence"))


def uncovered_organisations(seed: DataFrame, seed_oa: DataFrame, bridge: DataFrame) -> DataFrame:
    """Seeded organisations without a paper-side link: (org_id, canonical_name), the first name by order of text."""
    bridged = seed.join(bridge.select("assignee_id"), "assignee_id", "left_semi").select("org_id")
    open_ = seed.join(seed_oa.select("org_id").unionByName(bridged), "org_id", "left_anti")
    return open_.groupBy("org_id").agg(F.min("canonical_name").alias("canonical_name"))


def name_bridge(organisations: DataFrame, hits: DataFrame) -> DataFrame:
    """Institutions whose name holds all words of an organisation's; the organisation with most words claims first.

    ``hits`` has (org_id, institution_id, display_name): what a search by each organisation's name found.
    """
    words = lambda c: token_set(organisation_name(F.col(c)))
    own = organisations.select("org_id", words("canonical_name").alias("own"))
    fits = hits.join(own, "org_id").where((F.size("own") > 0) & (F.size(F.array_except("own", words("display_name"))) == 0))
    best = first_per_key(fits, "institution_id", [F.size("own").desc(), F.col("org_id")])
    return best.select("org_id", "institution_id", "display_name", F.lit("ror_bridge").alias("match_method"), F.lit("high").alias("confidence"))


def crosswalk(seed: DataFrame, seed_oa: DataFrame, ror: DataFrame, bridge: DataFrame, patent_side: DataFrame, paper_side: DataFrame) -> DataFrame:
    """(org_id, source, source_id, canonical_name, match_method, confidence): each source id once.

    Paper side: seeds, then the name bridge, then the fuzzy bridge, then the institution by itself. Patent side: seeds,
    then assignees that an unclaimed institution matched, then the assignee by itself. Each layer gives way to those before.
    """

    def rows(df: DataFrame, org: Column, source: str, sid: str, name: Column, layer: int, method: Column | None = None, confidence: Column | None = None) -> DataFrame:
        return df.select(org.alias("org_id"), F.lit(source).alias("source"), F.col(sid).alias("source_id"), name.alias("canonical_name"), (F.col("match_method") if method is None else method).alias("match_method"), (F.col("confidence") if confidence is None else confidence).alias("confidence"), F.lit(layer).alias("layer"))

    c, high = F.col, F.lit("high")
    claimed = seed_oa.select("institution_id").unionByName(ror.select("institution_id"))
    free = first_per_key(bridge.join(claimed, "institution_id", "left_anti"), "institution_id", [c("similarity").desc(), c("assignee_id")])
    seeded = first_per_key(seed, "assignee_id", [c("org_id")]).select("assignee_id", c("org_id").alias("seed_org"))
    known = patent_side.select("assignee_id", c("display_name").alias("pv_name"), c("normalized_name").alias("pv_norm"))
    named = paper_side.select("institution_id", c("display_name").alias("oa_name"))
    f = free.join(seeded, "assignee_id", "left").join(known, "assignee_id", "left").join(named, "institution_id", "left")
    own_org = lambda norm: F.concat(F.lit("org_pv_"), slug(norm))
    f = f.withColumn("org", F.coalesce("seed_org", own_org(F.coalesce("pv_norm", "assignee_id"))))
    # an assignee matched by several institutions takes the first institution's method
    emitted = first_per_key(f.where("seed_org is null"), "assignee_id", [c("institution_id")])
    by_id = F.concat(F.lit("org_oa_"), F.coalesce(F.nullif(slug(c("normalized_name")), F.lit("")), slug(F.substring_index("institution_id", "/", -1))))
    layers = [
        rows(seed, c("org_id"), "patentsview", "assignee_id", c("canonical_name"), 0),
        rows(seed_oa, c("org_id"), "openalex", "institution_id", c("display_name"), 1),
        rows(ror, c("org_id"), "openalex", "institution_id", c("display_name"), 2),
        rows(f, c("org"), "openalex", "institution_id", F.coalesce("oa_name", "institution_id"), 3),
        rows(emitted, c("org"), "patentsview", "assignee_id", F.coalesce("pv_name", "assignee_id"), 3),
        rows(patent_side, own_org(c("normalized_name")), "patentsview", "assignee_id", c("display_name"), 4, F.lit("native_id"), high),
        rows(paper_side, by_id, "openalex", "institution_id", c("display_name"), 5, F.lit("ror"), high),
    ]
    every = layers[0]
    for x in layers[1:]:
        every = every.unionByName(x)
    return first_per_key(every, ["source", "source_id"], [c("layer"), c("org_id"), c("canonical_name").asc_nulls_last()]).drop("layer")


def doi_links(references: DataFrame, papers: DataFrame) -> DataFrame:
    """Exact links by DOI; of papers sharing one, that of greatest id."""
    own = papers.where("doi_bare <> ''").groupBy(F.col("doi_bare").alias("doi_extracted")).agg(F.max("work_id").alias("work_id"))
    return references.where("doi_extracted is not null").join(own, "doi_extracted").select("patent_id", "work_id", F.lit("npl_citation").alias("match_method"), F.lit("high").alias("confidence"), "doi_extracted", F.lit(100.0).alias("score"))


def candidates(queries: DataFrame, documents: DataFrame, query_id: str, document_id: str, tokens: str = "tokens", most: int = MOST_CANDIDATES, postings: int = MOST_POSTINGS) -> DataFrame:
    """(query, document, shared): for each query the ``most`` documents that share most tokens; ties by document id.

    Both inputs carry an array of distinct tokens. Tokens of more than ``postings`` documents are no evidence and go before
    the join, which also bounds what any token's rows multiply to.
    """
    d = documents.select(document_id, F.explode(tokens).alias("token"))
    common = d.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > postings)
    d = d.join(common, "token", "left_anti")
    q = queries.select(query_id, F.explode(tokens).alias("token"))
    shared = q.join(d, "token").groupBy(query_id, document_id).agg(F.count("*").alias("shared"))
    return first_per_key(shared, query_id, [F.col("shared").desc(), F.col(document_id)], most)


def title_matches(references: DataFrame, papers: DataFrame) -> DataFrame:
    """Best title of each reference without a DOI: (patent_id, ref_sequence, work_id, score)."""
    refs = references.where(F.col("doi_extracted").isNull() & (F.length("ref_text") >= LEAST_REFERENCE)).withColumn("__ref", F.xxhash64("patent_id", "ref_sequence", "ref_text"))
    titles = papers.where((F.size(F.split(F.trim("title"), r"\s+")) >= LEAST_TITLE_WORDS)).select("work_id", F.lower("title").alias("title"), late_tokens(F.col("title")).alias("tokens"))
    found = candidates(refs.select("__ref", late_tokens(F.col("ref_text")).alias("tokens")), titles, "__ref", "work_id")
    texts = found.join(refs.select("__ref", "patent_id", "ref_sequence", F.lower("ref_text").alias("ref_text")), "__ref").join(titles.select("work_id", "title"), "work_id")
    scored = texts.withColumn("score", token_set_ratio("title", "ref_text"))
    best = first_per_key(scored, ["patent_id", "ref_sequence"], [F.col("score").desc(), F.col("shared").desc(), F.col("work_id")])
    return best.select("patent_id", "ref_sequence", "work_id", "score")


def gold_links(published: DataFrame, patents: DataFrame, papers: DataFrame) -> DataFrame:
    return semi(semi(published, patents, "patent_id"), papers, "work_id").select("patent_id", "work_id", "confscore").distinct()


def choose_threshold(matches: DataFrame, gold: DataFrame, thresholds: Sequence[int] = THRESHOLDS, least: float = LEAST_PRECISION) -> int:
    """The lowest threshold whose links, on patents with gold links, are right often enough; else the highest."""
    judged = semi(matches, gold.select("patent_id").distinct(), "patent_id")
    pairs = judged.groupBy("patent_id", "work_id").agg(F.max("score").alias("score")).join(gold.select("patent_id", "work_id").distinct().withColumn("right", F.lit(1)), ["patent_id", "work_id"], "left")
    counts = [F.count(F.when((F.col("score") >= t) & hit, 1)).alias(f"{name}{t}") for t in thresholds for name, hit in (("found", F.lit(True)), ("right", F.col("right").isNotNull()))]
    row = pairs.agg(*counts).first()  # one pass for all thresholds
    return min((t for t in thresholds if row[f"found{t}"] and row[f"right{t}"] / row[f"found{t}"] >= least), default=max(thresholds))


def matched_links(references: DataFrame, papers: DataFrame, gold: DataFrame | None = None, threshold: int | None = None) -> DataFrame:
    """(patent_id, work_id, match_method, confidence, doi_extracted, score): one row a pair, exact links before fuzzy ones."""
    fuzzy = title_matches(references, papers)
    if threshold is None and gold is not None:
        fuzzy = materialise(fuzzy)  # read for the choice and for the links
    if threshold is None:
        threshold = choose_threshold(fuzzy, gold) if gold is not None else max(THRESHOLDS)
    f = fuzzy.where(F.col("score") >= threshold).select("patent_id", "work_id", F.lit("npl_citation").alias("match_method"), F.lit("medium").alias("confidence"), F.lit(None).cast("string").alias("doi_extracted"), "score")
    every = doi_links(references, papers).unionByName(f)
    return first_per_key(every, ["patent_id", "work_id"], [F.when(F.col("confidence") == "high", 0).otherwise(1), F.col("score").desc(), F.col("doi_extracted")])


def published_links(raw: DataFrame, patents: DataFrame, papers: DataFrame) -> DataFrame:
    """Links of a published list in scope, the best citation place of each pair: both, front, body, then score, then self."""
    parsed = raw.select(F.regexp_extract("patent", "^us-([0-9]+)-", 1).alias("patent_id"), F.concat(F.lit("W"), F.col("oaid").cast("string")).alias("work_id"), F.col("confscore").cast("int").alias("confscore"), "wherefound", "self")
    own = semi(semi(parsed, patents, "patent_id"), papers, "work_id")
    place = F.when(F.col("wherefound") == "both", 0).when(F.col("wherefound") == "front", 1).otherwise(2)
    best = first_per_key(own, ["patent_id", "work_id"], [place, F.col("confscore").desc(), F.col("self").asc_nulls_last()])
    return best.select("patent_id", "work_id", F.lit("npl_citation").alias("match_method"), link_confidence(F.col("wherefound")).alias("confidence"), "confscore", "wherefound", "self")
