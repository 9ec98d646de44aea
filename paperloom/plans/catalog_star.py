"""Registered queries of the staged tables, facts and serving questions, over relations shaped like raw inputs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pieces
from ..functions import text as X
from ..operators import clusters, density, distinct, gate, languages, matching, projection, quality, substrings
from ..session import materialise, shared_folder
from ..sources import files, snapshots
from . import facts, feasibility, marts, serving, staging
from .catalog import _SHAPES, _TABLES, Load, _sql, crosswalk_cascade, query, shaped, star

c = F.col

#: Raw inputs in SQL that both engines read.
_SHAPES |= {
    "patents": """
SELECT cast(o_orderkey AS string) AS patent_id, CASE WHEN o_orderkey % 9 = 0 THEN 'Kernel 1.2' WHEN o_orderkey % 9 = 1 THEN ' ' ELSE concat('Method of ', o_orderpriority) END AS patent_title,
       cast(cast(cast(o_orderdate AS date) + INTERVAL '700' DAY AS date) AS string) AS patent_date, 'utility' AS patent_type FROM {orders}""",
    "applications": "SELECT cast(o_orderkey AS string) AS patent_id, cast(cast(o_orderdate AS date) AS string) AS filing_date FROM {orders} WHERE o_orderkey % 17 <> 0",
    "stray": "SELECT cast(NULL AS string) AS patent_id, 'No id' AS patent_title, '1996-01-01' AS patent_date, 'utility' AS patent_type, '1995-01-01' AS filing_date FROM {supplier} UNION ALL SELECT concat('S', s_suppkey), 'No day', '1996-01-01', 'utility', cast(NULL AS string) FROM {supplier}",
    "codes": """
SELECT cast(l_orderkey AS string) AS patent_id, CASE l_partkey % 8 WHEN 0 THEN 'G03F7/2004' WHEN 1 THEN 'G03F7/70' WHEN 2 THEN 'H01S5/10' WHEN 3 THEN 'G02B6/122' WHEN 4 THEN 'G11C11/54' WHEN 5 THEN 'H04L9/00' WHEN 6 THEN 'G06N3/049' END AS cpc_group,
       concat('S', l_partkey % 8) AS cpc_subclass, 'G03' AS cpc_class, 'G' AS cpc_section, 'inventional' AS cpc_type, cast(l_linenumber - 1 AS string) AS cpc_sequence FROM {lineitem}""",
    "assignees": """
SELECT cast(l_orderkey AS string) AS patent_id, CASE WHEN l_suppkey % 10 <> 6 THEN concat('A', l_suppkey) END AS assignee_id, CASE WHEN l_suppkey % 19 = 0 THEN '  ' WHEN l_suppkey % 10 = 7 THEN NULL ELSE concat('Firm ', l_suppkey % 50, ' Inc.') END AS disambig_assignee_organization,
       CASE l_partkey % 4 WHEN 0 THEN '2' WHEN 1 THEN '3' WHEN 2 THEN '4' ELSE '7' END AS assignee_type, cast(l_linenumber - 1 AS string) AS assignee_sequence FROM {lineitem}""",
    "refs": """
SELECT cast(l_orderkey AS string) AS patent_id, cast(l_linenumber AS string) AS other_reference_sequence, CASE l_partkey % 3 WHEN 0 THEN concat('See 10.1000/ABC.', l_suppkey, '; p. 3') WHEN 1 THEN concat('Smith, no doi, ', l_partkey) END AS other_reference_text FROM {lineitem}""",
    "citations": "SELECT cast(l_orderkey AS string) AS patent_id, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE cast(l_partkey AS string) END AS citation_patent_id FROM {lineitem}",
    "works": """
SELECT CASE WHEN c_custkey % 13 <> 5 THEN concat('https://works.test/W', c_custkey) END AS openalex_id, CASE c_custkey % 10 WHEN 0 THEN concat('https://doi.org/10.7910/DVN/', c_custkey) WHEN 1 THEN NULL ELSE concat('https://doi.org/10.1000/abc.', c_custkey) END AS doi,
       CASE c_custkey % 11 WHEN 0 THEN 'plot.PNG' WHEN 1 THEN 'seL4 3.0.1' WHEN 2 THEN NULL ELSE concat('On ', c_name) END AS title, 'article' AS type, CASE WHEN c_custkey % 14 <> 5 THEN cast(make_date(cast(1993 + c_custkey % 4 AS int), cast(1 + c_custkey % 12 AS int), 1) AS string) END AS publication_date,
       cast(1993 + c_custkey % 4 AS string) AS publication_year, 'en' AS language, CASE WHEN c_custkey % 3 = 0 THEN 'A neuron spikes.' WHEN c_custkey % 3 = 1 THEN 'A memristor.' END AS abstract,
       CASE c_custkey % 5 WHEN 0 THEN 'https://openalex.org/T11338' WHEN 1 THEN 'https://openalex.org/T10502' ELSE 'https://openalex.org/T1' END AS primary_topic_id, 'topic' AS primary_topic_name,
       list_value(concat('I', c_nationkey), concat('J', c_custkey % 5)) AS institution_ids, list_value('r', 'r') AS institution_rors, list_value(concat('Labs ', c_nationkey, ' Ltd'), CASE WHEN c_custkey % 2 = 0 THEN concat('Joint ', c_custkey % 5) END) AS institution_display_names FROM {customer}""",
    "excluded": "SELECT concat('W', c_custkey) AS doc_id, 'paper' AS doc_type, 'x' AS reason FROM {customer} WHERE c_custkey % 23 = 0 UNION ALL SELECT cast(o_orderkey AS string), 'patent', 'x' FROM {orders} WHERE o_orderkey % 29 = 0",
    "bridge": """
SELECT concat('W', c_custkey) AS doc_id, 'paper' AS doc_type, concat('c_', c_custkey % 7) AS cluster_id, cast(0.5 AS float) AS umap_x, cast(1.5 AS float) AS umap_y, 'v1' AS model_version FROM {customer} WHERE c_custkey % 4 <> 0
UNION ALL SELECT cast(o_orderkey AS string), 'patent', CASE WHEN o_orderkey % 6 = 0 THEN 'c_noise' ELSE concat('c_', o_orderkey % 6) END, cast(0.25 AS float), cast(2.5 AS float), 'v1' FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "crosswalk": "SELECT concat('org_', n_nationkey) AS org_id, 'openalex' AS source, concat('I', n_nationkey) AS source_id, n_name AS canonical_name, 'ror' AS match_method, 'high' AS confidence FROM {nation} UNION ALL SELECT concat('org_s', s_suppkey % 40), 'patentsview', concat('A', s_suppkey), s_name, 'native_id', 'high' FROM {supplier} WHERE s_suppkey % 3 <> 0",
    "published": "SELECT concat('us-', l_orderkey, '-A1') AS patent, cast(l_partkey AS string) AS oaid, cast(l_linenumber AS string) AS confscore, CASE l_linenumber % 3 WHEN 0 THEN 'both' WHEN 1 THEN 'front' ELSE 'body' END AS wherefound, CASE WHEN l_suppkey % 2 = 0 THEN 'self' ELSE 'notself' END AS self FROM {lineitem}",
    "seed": "SELECT concat('org_seed_', n_nationkey) AS org_id, n_name AS canonical_name, concat('firm ', n_nationkey * 3) AS normalized_patentsview, CASE WHEN n_nationkey % 3 = 0 THEN ' ' ELSE concat('I', n_nationkey) END AS openalex_institution_id FROM {nation}",
}
_START, _END = "1994-01-01", "1997-12-31"

#: The same tables in SQL alone, in order; each may read those before it.
_TABLE_SQL = {
    "scoped": f"""
SELECT p.patent_id, patent_title, patent_date, patent_type, filing_date FROM patents p JOIN applications a ON a.patent_id = p.patent_id
WHERE a.filing_date::DATE BETWEEN DATE '{_START}' AND DATE '{_END}' AND p.patent_id IN (
  SELECT patent_id FROM codes WHERE ({" OR ".join(f"cpc_group LIKE '{p}%'" for p in staging.SCOPE_PREFIXES)}) AND TRY_CAST(TRY_CAST(cpc_sequence AS DOUBLE) AS INT) <= {staging.LAST_SEQUENCE})""",
    "stg_works": f"""
SELECT openalex_id AS work_url, regexp_extract(openalex_id, 'W([0-9]+)', 0) AS work_id, doi, lower(regexp_replace(coalesce(doi, ''), '{X.DOI_PREFIX}', '')) AS doi_bare, title, type, publication_date::DATE AS publication_date, publication_year::INT AS publication_year,
       language, abstract, primary_topic_id, primary_topic_name, institution_ids, institution_rors, institution_display_names FROM works
WHERE openalex_id IS NOT NULL AND title IS NOT NULL AND publication_date IS NOT NULL AND coalesce(NOT contains(doi, '10.7910/'), TRUE) AND NOT regexp_matches(lower(title), '\\.(jpg|jpeg|png|tif|tiff|csv|xlsx|nc|mat|zip)$') AND NOT regexp_matches(title, '{X.STAGED_VERSION_TITLE}')
  AND regexp_extract(openalex_id, 'W([0-9]+)', 0) NOT IN (SELECT doc_id FROM excluded WHERE doc_type = 'paper')""",
    "stg_patents": "SELECT patent_id, patent_title AS title, filing_date::DATE AS filing_date, patent_date::DATE AS grant_date, patent_type FROM (SELECT * FROM scoped UNION ALL SELECT * FROM stray) WHERE patent_id IS NOT NULL AND filing_date IS NOT NULL AND patent_id NOT IN (SELECT doc_id FROM excluded WHERE doc_type = 'patent')",
    "stg_assignees": "SELECT patent_id, assignee_id, disambig_assignee_organization AS org_name, assignee_type, assignee_sequence::INT AS assignee_sequence FROM assignees WHERE assignee_id IS NOT NULL AND disambig_assignee_organization IS NOT NULL AND assignee_type IN ('2', '3', '6', '7') AND patent_id IN (SELECT patent_id FROM stg_patents)",
    "stg_codes": "SELECT patent_id, cpc_group, cpc_subclass, cpc_class, cpc_section, cpc_type, cpc_sequence::INT AS cpc_sequence FROM codes WHERE cpc_group IS NOT NULL AND patent_id IN (SELECT patent_id FROM stg_patents)",
    "stg_refs": f"SELECT patent_id, other_reference_sequence::INT AS ref_sequence, other_reference_text AS ref_text, nullif(rtrim(lower(regexp_extract(other_reference_text, '{X.DOI_PATTERN}', 0)), '.,;:'), '') AS doi_extracted FROM refs WHERE other_reference_text IS NOT NULL AND patent_id IN (SELECT patent_id FROM stg_patents)",
    "stg_citations": "SELECT patent_id AS citing_patent_id, citation_patent_id AS cited_patent_id FROM citations WHERE citation_patent_id IS NOT NULL AND patent_id IN (SELECT patent_id FROM stg_patents)",
    "published_best": """
SELECT patent_id, work_id, 'npl_citation' AS match_method, CASE WHEN wherefound IN ('both', 'front') THEN 'high' ELSE 'medium' END AS confidence, confscore, wherefound, self FROM (
  SELECT *, row_number() OVER (PARTITION BY patent_id, work_id ORDER BY CASE wherefound WHEN 'both' THEN 0 WHEN 'front' THEN 1 ELSE 2 END, confscore DESC, self NULLS LAST) AS n FROM (
    SELECT regexp_extract(patent, '^us-([0-9]+)-', 1) AS patent_id, 'W' || oaid AS work_id, confscore::INT AS confscore, wherefound, self FROM published)
  WHERE patent_id IN (SELECT patent_id FROM stg_patents) AND work_id IN (SELECT work_id FROM stg_works)) WHERE n = 1""",
    "matched": """
SELECT DISTINCT patent_id, work_id, 'npl_citation' AS match_method, 'high' AS confidence, doi_extracted, 100.0::DOUBLE AS score FROM stg_refs
JOIN (SELECT doi_bare, max(work_id) AS work_id FROM stg_works WHERE doi_bare <> '' GROUP BY 1) w ON w.doi_bare = doi_extracted""",
    "patent_orgs": "SELECT assignee_id, min(disambig_assignee_organization) AS display_name, regexp_replace(lower(min(disambig_assignee_organization)), ' inc\\.$', '') AS normalized_name, 'native_id' AS match_method, 'high' AS confidence FROM assignees WHERE assignee_type IN ('2', '3', '6', '7') AND trim(disambig_assignee_organization) <> '' AND patent_id IN (SELECT patent_id FROM scoped) GROUP BY 1",
    "paper_orgs": "SELECT institution_id, min(name) AS display_name, regexp_replace(lower(min(name)), ' ltd$', '') AS normalized_name, 'ror' AS match_method, 'high' AS confidence FROM (SELECT unnest(institution_ids) AS institution_id, unnest(institution_display_names) AS name FROM works) WHERE name IS NOT NULL GROUP BY 1",
}
_MARTS = {"mc": "mart_competitive", "gap": "mart_gap", "fam": "mart_family"}


def over(names: str, rest: str) -> str:
    """SQL over shapes, tables and marts by name, in the order given."""
    known = {k: k for k in _TABLES}
    bodies = {n: _SHAPES[n].format(**known) if n in _SHAPES else _TABLE_SQL[n] if n in _TABLE_SQL else _sql[_MARTS[n]] for n in names.split()}
    return "WITH " + ", ".join(f"{n} AS ({b})" for n, b in bodies.items()) + rest


RAW = "patents applications codes excluded scoped stray stg_patents"


def _scoped(t: Load) -> DataFrame:
    return staging.in_scope(shaped(t, "patents"), shaped(t, "applications"), shaped(t, "codes"), start=_START, end=_END)


def _patents(t: Load) -> DataFrame:
    """Staged patents of the scope and of stray rows that lack an id or a day."""
    return staging.staged_patents(_scoped(t).unionByName(shaped(t, "stray")), shaped(t, "excluded"))


def _works(t: Load) -> DataFrame:
    return staging.staged_works(shaped(t, "works"), shaped(t, "excluded"))


# --- staged tables -------------------------------------------------------------------------------------------------------


@query(over("patents applications codes scoped", " SELECT * FROM scoped"))
def scoped_patents(t: Load) -> DataFrame:
    return _scoped(t)


@query(over("works excluded stg_works", " SELECT work_url, work_id, doi, doi_bare, title, type, publication_date, publication_year, language, abstract, primary_topic_id, primary_topic_name, array_to_string(institution_ids, ',') AS institutions FROM stg_works"))
def stg_works(t: Load) -> DataFrame:
    return _works(t).withColumn("institutions", F.array_join("institution_ids", ",")).drop("institution_ids", "institution_rors", "institution_display_names")


@query(over(RAW, " SELECT * FROM stg_patents"))
def stg_patents(t: Load) -> DataFrame:
    return _patents(t)


@query(over(f"{RAW} assignees stg_assignees", " SELECT * FROM stg_assignees"))
def stg_assignees(t: Load) -> DataFrame:
    return staging.staged_assignees(shaped(t, "assignees"), _patents(t))


@query(over(f"{RAW} stg_codes", " SELECT * FROM stg_codes"))
def stg_codes(t: Load) -> DataFrame:
    return staging.staged_codes(shaped(t, "codes"), _patents(t))


@query(over(f"{RAW} refs stg_refs", " SELECT * FROM stg_refs"))
def stg_references(t: Load) -> DataFrame:
    return staging.staged_references(shaped(t, "refs"), _patents(t))


@query(over(f"{RAW} citations stg_citations", " SELECT * FROM stg_citations"))
def fact_patent_citation(t: Load) -> DataFrame:
    return facts.patent_citations(staging.staged_citations(shaped(t, "citations"), _patents(t)))


# --- organisations and links ---------------------------------------------------------------------------------------------


@query(over("patents applications codes scoped assignees patent_orgs", " SELECT * FROM patent_orgs"))
def patent_side_organisations(t: Load) -> DataFrame:
    return matching.patent_side_organisations(shaped(t, "assignees"), _scoped(t))


@query(over("works paper_orgs", " SELECT * FROM paper_orgs"))
def paper_side_organisations(t: Load) -> DataFrame:
    return matching.paper_side_organisations(shaped(t, "works"))


@query(over("patents applications codes scoped assignees patent_orgs seed", " SELECT org_id, canonical_name, assignee_id, display_name, 'seed_crosswalk' AS match_method, 'high' AS confidence FROM patent_orgs JOIN seed ON normalized_patentsview = normalized_name"))
def seed_matches(t: Load) -> DataFrame:
    return matching.seed_matches(shaped(t, "seed"), patent_side_organisations(t))


@query(over("patents applications codes scoped assignees patent_orgs seed", " SELECT org_id, canonical_name FROM seed WHERE normalized_patentsview NOT IN (SELECT normalized_name FROM patent_orgs)"))
def seed_unmatched(t: Load) -> DataFrame:
    return matching.seed_unmatched(shaped(t, "seed"), patent_side_organisations(t)).select("org_id", "canonical_name")


@query(over("works paper_orgs seed", " SELECT org_id, canonical_name, institution_id, display_name, 'seed_crosswalk' AS match_method, 'high' AS confidence FROM paper_orgs JOIN seed ON openalex_institution_id = institution_id WHERE trim(openalex_institution_id) <> ''"))
def seed_institutions(t: Load) -> DataFrame:
    return matching.seed_institutions(shaped(t, "seed"), paper_side_organisations(t))


@query("""
WITH o AS (SELECT 'o' || n_nationkey AS org_id, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE n_name || ' Labs Inc.' END AS canonical_name, string_split(lower(CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE n_name || ' Labs' END), ' ') AS w FROM nation),
h AS (SELECT a.org_id, 'I' || b.n_nationkey AS institution_id, 'National ' || b.n_name || CASE WHEN b.n_nationkey % 4 = 1 THEN ' Labs' ELSE ' Institute' END AS display_name, a.w FROM o a JOIN nation b ON 'o' || b.n_nationkey = a.org_id OR 'o' || (b.n_nationkey + 1) = a.org_id)
SELECT org_id, institution_id, display_name, 'ror_bridge' AS match_method, 'high' AS confidence FROM (
  SELECT *, row_number() OVER (PARTITION BY institution_id ORDER BY len(w) DESC, org_id) AS n FROM h WHERE list_has_all(string_split(lower(display_name), ' '), w)) WHERE n = 1""")
def name_bridge(t: Load) -> DataFrame:
    n, key = t("nation"), c("n_nationkey").cast("string")
    orgs = n.select(F.concat(F.lit("o"), key).alias("org_id"), F.when(c("n_nationkey") % 2 == 0, c("n_name")).otherwise(F.concat("n_name", F.lit(" Labs Inc."))).alias("canonical_name"))
    near = n.select(F.explode(F.array(c("n_nationkey"), c("n_nationkey") + 1)).alias("of"), F.concat(F.lit("I"), key).alias("institution_id"), F.concat(F.lit("National "), "n_name", F.when(c("n_nationkey") % 4 == 1, " Labs").otherwise(" Institute")).alias("display_name"))
    hits = near.select(F.concat(F.lit("o"), c("of").cast("string")).alias("org_id"), "institution_id", "display_name").join(orgs.select("org_id"), "org_id")
    return matching.name_bridge(orgs, hits)


@query(over(f"{RAW} works stg_works published published_best", " SELECT * FROM published_best"))
def published_links(t: Load) -> DataFrame:
    return matching.published_links(shaped(t, "published"), _patents(t), _works(t))


@query(over(f"{RAW} works stg_works refs stg_refs matched", " SELECT * FROM matched"))
def matched_links(t: Load) -> DataFrame:
    return matching.matched_links(staging.staged_references(shaped(t, "refs"), _patents(t)), _works(t))


# --- dimensions and facts ------------------------------------------------------------------------------------------------


@query(f"""
WITH x AS ({_sql["crosswalk_cascade"]})
SELECT org_id, canonical_name, match_method AS primary_match_method, confidence AS primary_confidence FROM (SELECT *, row_number() OVER (PARTITION BY org_id ORDER BY
  CASE match_method WHEN 'seed_crosswalk' THEN 1 WHEN 'fuzzy_high' THEN 2 WHEN 'native_id' THEN 3 WHEN 'ror' THEN 4 ELSE 5 END, canonical_name NULLS LAST, source_id NULLS LAST) AS n FROM x) WHERE n = 1""")
def dim_organization(t: Load) -> DataFrame:
    return facts.organisations(crosswalk_cascade(t))


@query(over(f"{RAW} stg_codes", " SELECT DISTINCT cpc_group, cpc_subclass, cpc_class, cpc_section FROM stg_codes"))
def dim_cpc(t: Load) -> DataFrame:
    return facts.codes(staging.staged_codes(shaped(t, "codes"), _patents(t)))


@query(over(f"{RAW} works stg_works", " SELECT 'paper' AS side, work_id AS id, title, publication_date AS day FROM stg_works UNION ALL SELECT 'patent', patent_id, title, filing_date FROM stg_patents"))
def dim_paper_and_patent(t: Load) -> DataFrame:
    papers = facts.papers(_works(t)).select(F.lit("paper").alias("side"), c("work_id").alias("id"), "title", c("publication_date").alias("day"))
    return papers.unionByName(facts.patents(_patents(t)).select(F.lit("patent").alias("side"), c("patent_id").alias("id"), "title", c("filing_date").alias("day")))


@query(over("clusters", " SELECT cluster_id, tagline, 's' AS summary_friendly, 't' AS terms FROM clusters"))
def dim_technology_cluster(t: Load) -> DataFrame:
    return facts.technology_clusters(star(t).dim_technology_cluster).select("cluster_id", "tagline", "summary_friendly", F.array_join("top_terms", ",").alias("terms"))


@query(over(f"{RAW} works stg_works bridge", " SELECT * FROM bridge WHERE (doc_type = 'paper' AND doc_id IN (SELECT work_id FROM stg_works)) OR (doc_type = 'patent' AND doc_id IN (SELECT patent_id FROM stg_patents))"))
def fact_document_cluster(t: Load) -> DataFrame:
    return facts.document_clusters(shaped(t, "bridge"), _works(t), _patents(t))


@query(over("works excluded stg_works bridge crosswalk", """,
e AS (SELECT *, unnest(institution_ids) AS institution_id, lower(title || ' ' || coalesce(abstract, '')) AS said FROM stg_works)
SELECT e.work_id, publication_date, publication_year, primary_topic_id, title, abstract, e.institution_id, org_id, x.match_method AS org_match_method, x.confidence AS org_confidence, b.cluster_id,
  CASE WHEN primary_topic_id = 'https://openalex.org/T11338' THEN 'euv' WHEN primary_topic_id = 'https://openalex.org/T10502' AND regexp_matches(said, 'neuromorphic|spik|synap|neuron|brain') THEN 'neuromorphic'
       WHEN primary_topic_id = 'https://openalex.org/T10502' AND regexp_matches(said, 'memristor|rram|resistive|nonvolatile|phase.change|memory') THEN 'in_memory' END AS family_id
FROM e LEFT JOIN crosswalk x ON x.source = 'openalex' AND x.source_id = e.institution_id LEFT JOIN bridge b ON b.doc_type = 'paper' AND b.doc_id = e.work_id"""))
def fact_publication(t: Load) -> DataFrame:
    return facts.publications(_works(t), shaped(t, "crosswalk"), shaped(t, "bridge")).drop("primary_topic_name")


@query(over(f"{RAW} assignees stg_assignees stg_codes bridge crosswalk", """
SELECT p.patent_id, filing_date, grant_date, patent_type, k.cpc_group AS primary_cpc, CASE WHEN k.cpc_group LIKE 'G03F%' THEN 'euv' WHEN k.cpc_group LIKE 'H01S%' THEN 'lasers' WHEN k.cpc_group LIKE 'G02B%' THEN 'si_photonics'
       WHEN k.cpc_group LIKE 'G06N%' THEN 'neuromorphic' WHEN k.cpc_group LIKE 'G11C%' THEN 'in_memory' END AS family_id, a.assignee_id, a.org_name AS assignee_name, a.assignee_sequence, org_id, x.match_method AS org_match_method, x.confidence AS org_confidence, b.cluster_id
FROM stg_patents p LEFT JOIN stg_codes k ON k.patent_id = p.patent_id AND k.cpc_sequence = 0 LEFT JOIN stg_assignees a ON a.patent_id = p.patent_id
LEFT JOIN crosswalk x ON x.source = 'patentsview' AND x.source_id = a.assignee_id LEFT JOIN bridge b ON b.doc_type = 'patent' AND b.doc_id = p.patent_id"""))
def fact_patent_filing(t: Load) -> DataFrame:
    p = _patents(t)
    return facts.filings(p, staging.staged_assignees(shaped(t, "assignees"), p), staging.staged_codes(shaped(t, "codes"), p), shaped(t, "crosswalk"), shaped(t, "bridge"))


@query(over(f"{RAW} works stg_works published published_best refs stg_refs matched", """,
u AS (SELECT patent_id, work_id, match_method, confidence, 'marx_fuegi' AS link_source, NULL AS doi_extracted, confscore AS mf_confscore, wherefound AS mf_wherefound, self AS mf_self FROM published_best
      UNION ALL SELECT patent_id, work_id, match_method, confidence, 'doi', doi_extracted, NULL, NULL, NULL FROM matched WHERE patent_id NOT IN (SELECT patent_id FROM published_best))
SELECT u.*, publication_date, filing_date, date_diff('day', publication_date, filing_date)::INT AS citation_lag_days, round(date_diff('day', publication_date, filing_date) / 365.25::DOUBLE, 2) AS citation_lag_years
FROM u JOIN stg_works w ON w.work_id = u.work_id JOIN stg_patents p ON p.patent_id = u.patent_id WHERE publication_date < filing_date"""))
def fact_npl_link(t: Load) -> DataFrame:
    papers, p = materialise(_works(t)), materialise(_patents(t))  # read four times each, references twice
    matched = matching.matched_links(materialise(staging.staged_references(shaped(t, "refs"), p)), papers)
    return facts.links(matching.published_links(shaped(t, "published"), p, papers), matched, facts.papers(papers), facts.patents(p))


@query(over("filings bridge clusters works excluded stg_works", """,
v AS (SELECT cluster_id, CASE WHEN primary_cpc LIKE 'G03F%' THEN 'euv' WHEN primary_cpc LIKE 'H01S%' OR primary_cpc LIKE 'G02B%' THEN 'silicon_photonics' WHEN primary_cpc LIKE 'G11C%' THEN 'neuromorphic_in_memory' ELSE 'mixed' END AS vote
      FROM (SELECT DISTINCT cluster_id, patent_id, primary_cpc FROM filings WHERE cluster_id <> 'c_noise')
      UNION ALL SELECT cluster_id, CASE primary_topic_id WHEN 'https://openalex.org/T11338' THEN 'euv' WHEN 'https://openalex.org/T10502' THEN 'neuromorphic_in_memory' ELSE 'mixed' END FROM stg_works JOIN bridge ON doc_type = 'paper' AND doc_id = work_id WHERE cluster_id <> 'c_noise'),
k AS (SELECT cluster_id, vote, count(*) AS n FROM v GROUP BY 1, 2),
s AS (SELECT cluster_id, sum(n) AS total, sum(n) FILTER (vote <> 'mixed') AS real, arg_min(vote, (-n, vote)) FILTER (vote <> 'mixed') AS best, max(n) FILTER (vote <> 'mixed') AS most FROM k GROUP BY 1),
f AS (SELECT c.cluster_id, CASE WHEN most::DOUBLE / real >= 0.8 AND real::DOUBLE / total >= 0.5 THEN best ELSE 'mixed' END AS family_id FROM clusters c LEFT JOIN s ON s.cluster_id = c.cluster_id WHERE c.cluster_id <> 'c_noise')
SELECT cluster_id, family_id FROM f"""))
def cluster_families(t: Load) -> DataFrame:
    return marts.cluster_families(shaped(t, "filings"), facts.papers(_works(t)), shaped(t, "bridge"), shaped(t, "clusters")).select("cluster_id", "family_id")


# --- gate ----------------------------------------------------------------------------------------------------------------

_GATED = """,
d AS (SELECT 'W' || doc_id AS doc_id, trim(split_part(text, chr(10), 1)) AS title, trim(substr(text, length(split_part(text, chr(10), 1)) + 2)) AS abstract FROM documents),
g AS (SELECT doc_id, 'paper' AS doc_type, CASE WHEN length(abstract) < 50 THEN nullif(title, '') WHEN contains(abstract, 'the') THEN abstract WHEN title <> '' AND contains(title, 'the') THEN title END AS text,
             CASE WHEN length(abstract) < 50 THEN CASE WHEN title <> '' THEN 'title' END WHEN contains(abstract, 'the') THEN 'abstract' WHEN title <> '' AND contains(title, 'the') THEN 'title' END AS text_source,
             CASE WHEN length(abstract) < 50 THEN 'no_usable_text' ELSE 'non_english_content' END AS why FROM d
      UNION ALL SELECT patent_id, 'patent', CASE WHEN patent_title <> 'Kernel 1.2' THEN nullif(trim(patent_title), '') END, 'title', CASE WHEN patent_title = 'Kernel 1.2' THEN 'version_style_title' ELSE 'no_usable_text' END FROM patents)"""


def _gate_inputs(t: Load) -> tuple:
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    papers = t("documents").select(F.concat(F.lit("W"), c("doc_id").cast("string")).alias("work_id"), first.alias("title"), F.substr("text", F.length(first) + 2).alias("abstract"))
    return papers, shaped(t, "patents").select("patent_id", c("patent_title").alias("title")), lambda x: F.when(x.contains("the"), "en").otherwise("xx")


@query(over("patents", _GATED + " SELECT doc_id, doc_type, why AS reason FROM g WHERE text IS NULL"))
def gate_exclusions(t: Load) -> DataFrame:
    return gate.exclusions(*_gate_inputs(t))


@query(over("patents", _GATED + " SELECT doc_id, doc_type, md5(text) AS text_md5, text_source FROM g WHERE text IS NOT NULL"))
def gate_corpus(t: Load) -> DataFrame:
    return gate.corpus(*_gate_inputs(t)).select("doc_id", "doc_type", F.md5(c("text").cast("binary")).alias("text_md5"), "text_source")


# --- serving -------------------------------------------------------------------------------------------------------------


@query(over("fam", " SELECT family_id, family_name, family_sort_order, n_papers, n_patents, patent_share, n_research_orgs_sum, n_assignees_sum, median_lag_years_weighted, total_npl_links FROM fam"))
def serving_scorecard(t: Load) -> DataFrame:
    return serving.family_scorecard(star(t))


def _two(condition: str, name: str) -> str:
    return over("filings publications", f" SELECT (SELECT count(DISTINCT patent_id) FROM filings WHERE {condition}) AS {name}_patents, (SELECT count(DISTINCT work_id) FROM publications WHERE {condition}) AS {name}_papers")


@query(_two("family_id IS NULL", "unattributed"))
def unattributed_counts(t: Load) -> DataFrame:
    return serving.unattributed_counts(star(t))


@query(_two("cluster_id = 'c_noise'", "unclustered"))
def unclustered_counts(t: Load) -> DataFrame:
    return serving.unclustered_counts(star(t))


@query(over("gap", " SELECT cluster_id, tagline, 'mixed' AS family_id, 'Mixed' AS family_name, n_papers, n_patents, npl_median_lag_years, npl_reportable, npl_n_links, cohort_lag_years FROM gap WHERE cluster_id <> 'c_noise'"))
def cluster_bubble(t: Load) -> DataFrame:
    return serving.cluster_bubble(star(t))


@query(over("gap", """, real AS (SELECT * FROM gap WHERE cluster_id <> 'c_noise')
SELECT cluster_id, tagline, 's' AS summary_friendly, n_papers, n_patents, npl_median_lag_years, npl_reportable, npl_n_links, cohort_lag_years, 'mixed' AS family_id, 'Mixed' AS family_name,
  (SELECT sum(n_patents)::BIGINT FROM real) AS total_patents, (SELECT sum(n_papers)::BIGINT FROM real) AS total_papers, (SELECT sum(n_patents)::BIGINT FROM real) AS family_patents FROM real WHERE cluster_id = 'c_3'"""))
def cluster_card(t: Load) -> DataFrame:
    return serving.cluster_card(star(t), "c_3").drop("top_terms")


@query(over("filings publications", """,
a AS (SELECT publication_year AS year, count(DISTINCT work_id) AS n FROM publications WHERE family_id = 'euv' GROUP BY 1), b AS (SELECT year(filing_date)::INT AS year, count(DISTINCT patent_id) AS n FROM filings WHERE family_id = 'euv' GROUP BY 1)
SELECT s.year, coalesce(a.n, 0) AS paper_count, coalesce(b.n, 0) AS patent_count FROM (SELECT year FROM a UNION SELECT year FROM b) s LEFT JOIN a ON a.year = s.year LEFT JOIN b ON b.year = s.year"""))
def family_velocity(t: Load) -> DataFrame:
    return serving.family_velocity(star(t), "euv")


@query(over("mc", """, k AS (SELECT org_id, canonical_name, sum(doc_count)::BIGINT AS doc_count FROM mc WHERE family_id = 'euv' AND side = 'patent' AND cluster_id <> 'c_noise' AND canonical_name <> 'Unresolved' GROUP BY 1, 2)
SELECT *, (SELECT count(*) FROM k) AS total_orgs FROM k ORDER BY doc_count DESC, org_id LIMIT 50"""))
def family_leaderboard(t: Load) -> DataFrame:
    return serving.family_leaderboard(star(t), "euv", "patent")


@query(over("mc", " SELECT org_id, canonical_name, sum(doc_count)::BIGINT AS doc_count FROM mc WHERE cluster_id IN ('c_2', 'c_3') AND side = 'patent' AND canonical_name <> 'Unresolved' GROUP BY 1, 2 ORDER BY doc_count DESC, org_id LIMIT 10"))
def top_orgs(t: Load) -> DataFrame:
    return serving.top_orgs(star(t), ["c_2", "c_3"], "patent")


@query(over("mc orgs", """
SELECT canonical_name, org_id FROM orgs WHERE regexp_matches(org_id, '[05]$') AND org_id IN (SELECT org_id FROM mc WHERE cluster_id <> 'c_noise') AND canonical_name ILIKE '%supplier%' ORDER BY canonical_name, org_id LIMIT 50"""))
def search_orgs(t: Load) -> DataFrame:
    s = star(t)
    named = s.dim_organization.withColumn("primary_match_method", F.when(c("org_id").rlike("[05]$"), "seed_crosswalk").otherwise("native_id"))
    return serving.search_orgs(serving.Star(**vars(s) | {"dim_organization": named}), "supplier")


@query(over("links publications", """,
k AS (SELECT work_id, count(DISTINCT patent_id) AS n FROM links GROUP BY 1), p AS (SELECT DISTINCT work_id, 'Paper ' || work_id AS title, publication_year AS year FROM publications)
SELECT title || ' (' || year || ' · ' || n || ' patents)' AS label, work_id FROM p JOIN k USING (work_id) WHERE title ILIKE '%paper w1%' ORDER BY n DESC, work_id LIMIT 50"""))
def search_papers(t: Load) -> DataFrame:
    return serving.search_papers(star(t), "paper w1")


@query(over("orgs", " SELECT * FROM orgs WHERE org_id = 'org_3'"))
def org_profile(t: Load) -> DataFrame:
    return serving.org_profile(star(t), "org_3")


@query(over("mc", " SELECT family_id_key AS family_id, sum(doc_count)::BIGINT AS n_patents FROM mc WHERE org_id = 'org_3' AND side = 'patent' GROUP BY 1"))
def org_output_by_family(t: Load) -> DataFrame:
    return serving.org_output_by_family(star(t), "org_3", "patent")


@query(over("mc", " SELECT DISTINCT cluster_id, tagline, family_id_key AS family_id FROM mc WHERE org_id = 'org_3' AND cluster_id <> 'c_noise'"))
def org_active_scope(t: Load) -> DataFrame:
    return serving.org_active_scope(star(t), "org_3")


@query(over("mc", """
SELECT cluster_id, tagline, sum(doc_count)::BIGINT AS doc_count, sum(doc_count)::DOUBLE / max(cluster_total) AS share, 'mixed' AS family_id FROM mc WHERE org_id = 'org_3' AND side = 'patent' AND cluster_id <> 'c_noise' GROUP BY 1, 2 ORDER BY doc_count DESC, cluster_id LIMIT 5"""))
def org_top_clusters(t: Load) -> DataFrame:
    return serving.org_top_clusters(star(t), "org_3", "patent")


@query(over("filings", " SELECT year(filing_date)::INT AS year, count(DISTINCT patent_id) AS n_patents FROM filings WHERE org_id = 'org_3' GROUP BY 1"))
def org_filing_years(t: Load) -> DataFrame:
    return serving.org_filing_years(star(t), "org_3")


@query(over("publications", " SELECT publication_year AS year, count(DISTINCT work_id) AS n_papers FROM publications WHERE org_id = 'org_3' GROUP BY 1"))
def org_paper_years(t: Load) -> DataFrame:
    return serving.org_paper_years(star(t), "org_3")


@query(over("links publications", """
SELECT work_id, 'Paper ' || work_id AS title, (SELECT max(publication_date) FROM publications p WHERE p.work_id = x.work_id) AS publication_date, 'a' AS abstract, n AS n_citing_patents FROM (
  SELECT work_id, count(DISTINCT patent_id) AS n FROM links WHERE work_id IN (SELECT work_id FROM publications WHERE org_id = 'org_3') GROUP BY 1) x ORDER BY n DESC, work_id LIMIT 1"""))
def org_flagship_paper(t: Load) -> DataFrame:
    return serving.org_flagship_paper(star(t), "org_3")


@query(over("links filings", """
SELECT patent_id, 'Title of ' || patent_id AS title, (SELECT max(filing_date) FROM filings f WHERE f.patent_id = x.patent_id) AS filing_date, n AS n_papers_cited FROM (
  SELECT patent_id, count(DISTINCT work_id) AS n FROM links WHERE patent_id IN (SELECT patent_id FROM filings WHERE org_id = 'org_3') GROUP BY 1) x ORDER BY n DESC, patent_id LIMIT 1"""))
def org_flagship_patent(t: Load) -> DataFrame:
    return serving.org_flagship_patent(star(t), "org_3")


@query(over("publications orgs", """,
o AS (SELECT string_agg(DISTINCT canonical_name, ', ' ORDER BY canonical_name) AS org_name FROM publications p JOIN orgs ON orgs.org_id = p.org_id WHERE work_id = 'W42')
SELECT DISTINCT 'Paper W42' AS title, publication_date, 'a' AS abstract, 'topic' AS primary_topic_name, org_name, family_id FROM publications, o WHERE work_id = 'W42'"""))
def trace_paper(t: Load) -> DataFrame:
    return serving.trace_paper(star(t), "W42")


@query(over("fam", " SELECT family_name, median_lag_years_weighted, n_papers, n_patents, total_npl_links FROM fam WHERE family_id = 'euv'"))
def trace_family_stat(t: Load) -> DataFrame:
    return serving.trace_family_stat(star(t), "euv")


@query(over("links", " SELECT min(citation_lag_years) AS fastest, count(*) AS n_known FROM links WHERE citation_lag_years IS NOT NULL"))
def fastest_link(t: Load) -> DataFrame:
    return serving.fastest_link(shaped(t, "links"))


@query(over("gap", """
SELECT cluster_id, coalesce(CASE WHEN npl_reportable THEN npl_median_lag_years END, cohort_lag_years) AS lag_years,
       CASE WHEN npl_reportable AND npl_median_lag_years IS NOT NULL THEN 'linked' WHEN cohort_lag_years IS NOT NULL THEN 'cohort' ELSE 'none' END AS lag_basis FROM gap"""))
def shown_lag(t: Load) -> DataFrame:
    return serving.shown_lag(star(t).mart_gap).select("cluster_id", "lag_years", "lag_basis")


@query(over("mc filings publications", """,
o AS (SELECT coalesce(sum(doc_count) FILTER (side = 'paper'), 0)::BIGINT AS papers, coalesce(sum(doc_count) FILTER (side = 'patent'), 0)::BIGINT AS patents FROM mc WHERE org_id = 'org_3')
SELECT papers, patents, round(papers::DOUBLE / (SELECT count(DISTINCT work_id) FROM publications), 4) AS paper_share, round(patents::DOUBLE / (SELECT count(DISTINCT patent_id) FROM filings), 4) AS patent_share,
       CASE WHEN patents::DOUBLE / (papers + patents) >= 0.7 THEN 'Primarily an IP holder' WHEN patents::DOUBLE / (papers + patents) <= 0.3 THEN 'Primarily a research institution' ELSE 'Both researcher and IP holder' END AS role FROM o"""))
def org_role(t: Load) -> DataFrame:
    return serving.org_role(star(t), "org_3")


# --- display -------------------------------------------------------------------------------------------------------------


@query(over("publications", """
SELECT DISTINCT work_id, publication_date + floor((publication_year % 5 - 1.5) * 365.25)::INT AS marked, publication_date - 90 AS first_day FROM publications"""))
def chart_days(t: Load) -> DataFrame:
    days = shaped(t, "publications").select("work_id", "publication_date", (c("publication_year") % 5 - F.lit(1.5)).alias("years")).distinct()
    return days.select("work_id", X.day_after(c("publication_date"), c("years")).alias("marked"), F.date_sub("publication_date", X.BEFORE).alias("first_day"))


@query(f"""
WITH h AS ({_sql["hhi_by_region"]}), x AS (SELECT region, least(1, greatest(0, hhi * 20)) AS t FROM h)
SELECT region, '#' || printf('%02x%02x%02x', trunc(34 + 205 * t)::INT, trunc(197 - 129 * t)::INT, trunc(94 - 26 * t)::INT) AS colour, CASE WHEN region % 2 = 0 THEN '#22c55e' ELSE '#94a3b8' END AS trust FROM x""")
def display_colours(t: Load) -> DataFrame:
    from .catalog import hhi_by_region

    trust = F.when(c("region") % 2 == 0, "high").otherwise("unheard of")
    return hhi_by_region(t).select("region", X.concentration_colour(c("hhi") * 20).alias("colour"), X.trust_colour(trust).alias("trust"))


@query("""
SELECT doc_id, CASE WHEN length(text) <= 60 THEN text ELSE rtrim(CASE WHEN contains(substr(text, 1, 61), ' ') THEN regexp_replace(substr(text, 1, 61), ' [^ ]*$', '') ELSE substr(text, 1, 60) END, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) END AS snippet, length(text) > 60 AS cut FROM documents""")
def snippets(t: Load) -> DataFrame:
    return t("documents").select("doc_id", X.cut_at_word(c("text"), 60).alias("s")).select("doc_id", "s.snippet", "s.cut")


@query("SELECT vec_id, CASE WHEN label < 2 THEN 'c_noise' ELSE 'c_' || (label - 2) END AS cluster_id FROM embeddings")
def cluster_names(t: Load) -> DataFrame:
    return t("embeddings").select("vec_id", X.cluster_name(c("label") - 2).alias("cluster_id"))


# --- feasibility and data tests ------------------------------------------------------------------------------------------


@query(over(f"{RAW} stg_codes refs stg_refs works stg_works published published_best", """,
o AS (SELECT DISTINCT patent_id, CASE WHEN cpc_group LIKE 'G03F%' THEN 'euv' WHEN cpc_group LIKE 'H01S%' THEN 'lasers' WHEN cpc_group LIKE 'G02B%' THEN 'si_photonics' WHEN cpc_group LIKE 'G06N%' THEN 'neuromorphic' WHEN cpc_group LIKE 'G11C%' THEN 'in_memory' END AS family_id
      FROM stg_codes WHERE cpc_sequence = 0 AND substr(cpc_group, 1, 4) IN ('G03F', 'H01S', 'G02B', 'G06N', 'G11C')),
a AS (SELECT family_id, count(DISTINCT patent_id) AS n_patents FROM o GROUP BY 1),
b AS (SELECT family_id, count(DISTINCT o.patent_id) AS n_citing, count(DISTINCT CASE WHEN doi_extracted IS NOT NULL THEN o.patent_id END) AS n_with_doi FROM o JOIN stg_refs r ON r.patent_id = o.patent_id GROUP BY 1),
l AS (SELECT family_id, count(*) AS n_links FROM o JOIN published_best p ON p.patent_id = o.patent_id GROUP BY 1)
SELECT a.family_id, n_patents, coalesce(n_citing, 0) AS n_citing, coalesce(n_with_doi, 0) AS n_with_doi, coalesce(n_links, 0) AS n_links, round(coalesce(n_citing, 0)::DOUBLE / n_patents, 4) AS citing_share
FROM a LEFT JOIN b ON b.family_id = a.family_id LEFT JOIN l ON l.family_id = a.family_id"""))
def scope_feasibility(t: Load) -> DataFrame:
    p = _patents(t)
    return feasibility.scope_counts(p, staging.staged_codes(shaped(t, "codes"), p), staging.staged_references(shaped(t, "refs"), p), matching.published_links(shaped(t, "published"), p, _works(t)))


@query(over(f"{RAW} works stg_works", " SELECT 'paper' AS side, (SELECT count(*) FROM works) AS raw, (SELECT count(DISTINCT work_id) FROM stg_works) AS staged UNION ALL SELECT 'patent', (SELECT count(*) FROM scoped), (SELECT count(DISTINCT patent_id) FROM stg_patents)"))
def corpus_counts(t: Load) -> DataFrame:
    return feasibility.corpus_counts(shaped(t, "works"), _works(t), _scoped(t), _patents(t))


@query(over(f"{RAW} works stg_works published published_best refs stg_refs matched bridge", """,
u AS (SELECT patent_id, 'marx_fuegi' AS link_source FROM published_best UNION ALL SELECT patent_id, 'doi' FROM matched)
SELECT 'seam' AS "check", (SELECT count(*) FROM (SELECT patent_id FROM u GROUP BY 1 HAVING count(DISTINCT link_source) > 1)) AS violations
UNION ALL SELECT 'no_orphans', (SELECT count(*) FROM bridge WHERE (doc_type = 'paper' AND doc_id NOT IN (SELECT work_id FROM stg_works)) OR (doc_type = 'patent' AND doc_id NOT IN (SELECT patent_id FROM stg_patents)))
UNION ALL SELECT 'something_excluded', 0 UNION ALL SELECT 'nothing_excluded', 1"""))
def seam_and_orphans(t: Load) -> DataFrame:
    """Data tests on tables that break them: both kinds of links at once, unstaged documents, no exclusions."""
    papers, p, out = _works(t), _patents(t), shaped(t, "excluded")
    given = matching.published_links(shaped(t, "published"), p, papers).select("patent_id", F.lit("marx_fuegi").alias("link_source"))
    own = matching.matched_links(staging.staged_references(shaped(t, "refs"), p), papers).select("patent_id", F.lit("doi").alias("link_source"))
    return quality.report({
        "seam": quality.mixed_sources(given.unionByName(own)), "no_orphans": quality.orphaned_documents(shaped(t, "bridge"), papers, p),
        "something_excluded": quality.silently_empty(out, papers), "nothing_excluded": quality.silently_empty(out.limit(0), papers),
    })


# --- sources -------------------------------------------------------------------------------------------------------------


def _lake(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/lake-{uuid.uuid4().hex}"


@query("SELECT * FROM nation")
def snapshot_latest(t: Load) -> DataFrame:
    """Two snapshots are written in two steps; the later one is read."""
    n = t("nation")
    root = _lake(n)
    snapshots.write(n.where("n_nationkey < 3"), root, "raw", "nation", "2026-01-02")
    snapshots.write(n.where("n_nationkey < 9"), root, "raw", "nation", "2026-02-01")
    snapshots.write(n, root, "raw", "nation", "2026-02-01", again=True)
    return snapshots.latest(n.sparkSession, root, "raw", "nation")


@query("SELECT n_nationkey, '2026-02-01' AS version FROM nation UNION ALL SELECT n_nationkey, '2026-01-02' FROM nation WHERE n_nationkey < 3")
def snapshot_versions(t: Load) -> DataFrame:
    n = t("nation")
    root = _lake(n)
    snapshots.write(n.where("n_nationkey < 3"), root, "raw", "nation", "2026-01-02")
    snapshots.write(n, root, "raw", "nation", "2026-02-01")
    snapshots.write(n.limit(0), root, "raw", "nation", "2026-02-01")  # complete already: stays
    return snapshots.every_version(n.sparkSession, root, "raw", "nation").select("n_nationkey", "version")


@query("SELECT s_suppkey::INT AS s_suppkey, s_name, s_nationkey::VARCHAR AS s_nationkey FROM supplier")
def tsv_scan(t: Load) -> DataFrame:
    s = t("supplier").select("s_suppkey", "s_name", "s_nationkey")
    path = _lake(s)
    s.write.option("sep", "\t").option("header", True).csv(path)
    return files.read_tsv(s.sparkSession, path, ["s_suppkey", "s_name"], {"s_suppkey": "int"})


@query("SELECT r_regionkey::VARCHAR AS r_regionkey, r_name FROM region")
def csv_scan(t: Load) -> DataFrame:
    r = t("region").select("r_regionkey", "r_name")
    path = _lake(r)
    r.write.option("header", True).csv(path)
    return files.read_csv(r.sparkSession, path)


@query("SELECT 'https://works.test/W' || c_custkey AS openalex_id, c_name || ' ' || c_mktsegment AS abstract, 'I' || c_nationkey AS institutions FROM customer")
def json_works(t: Load) -> DataFrame:
    words = F.map_from_arrays(F.array("c_name", "c_mktsegment"), F.array(F.array(F.lit(0)), F.array(F.lit(1))))
    found = F.array(F.struct(F.concat(F.lit("I"), c("c_nationkey").cast("string")).alias("id"), F.lit("").alias("ror")), F.struct(F.lit(None).cast("string").alias("id"), F.lit("r").alias("ror")))
    raw = t("customer").select(F.concat(F.lit("https://works.test/W"), c("c_custkey").cast("string")).alias("id"), words.alias("abstract_inverted_index"), F.array(F.struct(found.alias("institutions"))).alias("authorships"))
    flat = files.parse_works(raw.select(F.to_json(F.struct("*")).alias("value")))
    return flat.select("openalex_id", "abstract", F.array_join("institution_ids", ",").alias("institutions"))


# --- counts, searches and clusters that are more than one plan --------------------------------------------------------------------


@query(_sql["dataset_totals"])
def bitmap_totals(t: Load) -> DataFrame:
    """Distinct documents of some families and clusters, from bitmaps of all."""
    s = star(t)
    chosen = c("kind").isin("n_papers", "n_patents") & c("family_id").isin("euv", "unattributed") & c("cluster_id").isin("c_2", "c_3")
    found = distinct.counted(distinct.document_bitmaps(s.fact_patent_filing, s.fact_publication), chosen)
    total = lambda kind: F.coalesce(F.max(F.when(c("kind") == kind, c("n"))), F.lit(0)).alias(f"total_{kind[2:]}")
    return found.agg(total("n_papers"), total("n_patents"))


@query("SELECT doc_id AS id FROM documents WHERE text ILIKE '%tion%the_or%'")
def substring_search(t: Load) -> DataFrame:
    """Documents that hold a pattern, by an index of three-letter sequences."""
    d = t("documents")
    path = _lake(d)
    substrings.build(d, "doc_id", "text", path)
    return substrings.search(d.sparkSession, path, "tion%the_or").select("id")


@query()
def review_band_bridge(t: Load) -> DataFrame:
    """Best match of each part's name, shortened or written otherwise, among the suppliers' at a score of 80 and more."""
    p = t("part").select("p_partkey", "p_name")
    k = c("p_partkey") % 3
    name = F.when(k == 0, F.expr("substring_index(p_name, ' ', 2)")).when(k == 1, F.regexp_replace("p_name", "e", "a")).otherwise(F.concat("p_name", F.lit("s")))
    left = t("part").select(c("p_partkey").alias("id"), name.alias("normalized_name"))
    right = t("supplier").select(c("s_suppkey").alias("p_partkey")).join(p, "p_partkey").select(c("p_partkey").alias("rid"), c("p_name").alias("normalized_name"))
    return matching.blocked_bridge(left, right, "id", "rid", review=80).select("id", "rid", F.round("similarity", 4).alias("similarity"), "match_method")


@query()
def token_lengths(t: Load) -> DataFrame:
    """Tokens of each document by a public vocabulary, and whether they pass the encoder's length."""
    import public_tokenizers

    d = t("documents")
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as lines:
        of = pieces.token_counts(d.sparkSession, pieces.read_vocabulary(x.rstrip("\n") for x in lines))
    return d.select("doc_id", of(c("text")).alias("tokens")).withColumn("truncated", c("tokens") > clusters.MOST_TOKENS)


@query()
def neighbour_projection(t: Load) -> DataFrame:
    """Positions of all vectors by their neighbour graph."""
    return projection.neighbour_plane(t("embeddings"), "vec_id")


@query()
def density_by_hierarchy(t: Load) -> DataFrame:
    """Clusters of unlike density among the vectors' first two components, smallest 50."""
    points = materialise(clusters.plane(t("embeddings"), "vec_id"))
    labels = density.hierarchical_clusters(points, "vec_id")
    return points.join(labels, "vec_id").select("vec_id", F.round("umap_x", 4).alias("umap_x"), F.round("umap_y", 4).alias("umap_y"), X.cluster_name(c("label")).alias("cluster_id"))


@query()
def language_by_profiles(t: Load) -> DataFrame:
    """Language of every document by profiles of two thirds of them, refused where its lead is too small."""
    d = t("documents").select("doc_id", "text", "lang")
    learned = d.where(F.pmod(F.crc32(c("doc_id").cast("string").cast("binary")), F.lit(3)) != 1)
    names, known = languages.profiles(learned)
    known = materialise(known)
    guesses = materialise(languages.guessed(d, names, known, "doc_id"))  # the margin is read from them too: ids are wholly inside or outside what was learned
    return languages.refused(guesses, languages.least_lead(guesses, learned, "doc_id")).select("doc_id", "guess", F.round("lead", 6).alias("lead"))
