"""Rule-based classifiers. Rules are ordered and the first met decides, unless stated otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekeeper.operators import lexicon as lex
from lorekeeper.operators.ranking import first_by
from lorekeeper.operators.rules import described, hits, ladder, mentions
from lorekeeper.registry import query
from lorekeeper.sources.archive import Archive

#: The source types that the driver's segments stand for.
TYPES = {"BUILDING": "institutional_archive", "AUTOMOBILE": "modern_web", "MACHINERY": "academic_metadata", "HOUSEHOLD": "community_repository", "FURNITURE": "public_domain_gutenberg"}
_TYPE_SQL = "CASE source_type WHEN 'BUILDING' THEN 'institutional_archive' WHEN 'AUTOMOBILE' THEN 'modern_web' WHEN 'MACHINERY' THEN 'academic_metadata' WHEN 'HOUSEHOLD' THEN 'community_repository' WHEN 'FURNITURE' THEN 'public_domain_gutenberg' ELSE '' END"

#: Families of source types by what their names hold, in order (fixed values). The report's and the page's taxonomies differ and stay apart.
REPORT_FAMILIES = [
    (["community"], "community_controlled_public"),
    (["repository"], "repository_texts"),
    (["modern_web", "seeded_public_web"], "modern_public_web"),
    (["public_domain", "gutenberg", "wikisource", "sacred_texts"], "public_domain_books"),
    (["institutional", "municipal"], "institutional_or_local_studies"),
    (["academic", "catalogue", "metadata", "andc", "archive"], "academic_catalogue_metadata"),
]
PAGE_FAMILIES = [
    (["community"], "community"),
    (["repository", "archive", "trove", "newspaper", "magazine"], "repository"),
    (["modern_web", "seeded_public_web", "public_web", "haunted_places", "yowie_report", "yowie_state"], "modern_web"),
    (["public_domain", "gutenberg", "wikisource", "sacred_texts"], "public_domain"),
    (["institutional", "municipal"], "institutions"),
    (["academic", "catalogue", "metadata", "andc", "openalex", "crossref", "wikidata", "openlibrary"], "academic"),
]


def source_type():
    mapped = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    return F.coalesce(F.element_at(mapped, F.col("source_type")), F.lit(""))


def family(kind, families, default: str):
    return ladder([(mentions(F.lower(kind), terms), name) for terms, name in families], default)


@query(f"SELECT source_id, CASE WHEN t LIKE '%community%' THEN 'community_controlled_public' WHEN t LIKE '%repository%' THEN 'repository_texts' WHEN t LIKE '%modern_web%' THEN 'modern_public_web' WHEN t LIKE '%public_domain%' OR t LIKE '%gutenberg%' THEN 'public_domain_books' WHEN t LIKE '%institutional%' OR t LIKE '%municipal%' THEN 'institutional_or_local_studies' WHEN t LIKE '%academic%' OR t LIKE '%archive%' THEN 'academic_catalogue_metadata' ELSE 'other_public_sources' END AS family FROM (SELECT source_id, {_TYPE_SQL} AS t FROM sources)")
def source_family_py(a: Archive) -> DataFrame:
    return a.sources.select("source_id", family(source_type(), REPORT_FAMILIES, "other_public_sources").alias("family"))


@query(f"SELECT source_id, CASE WHEN t LIKE '%community%' THEN 'community' WHEN t LIKE '%repository%' OR t LIKE '%archive%' THEN 'repository' WHEN t LIKE '%modern_web%' THEN 'modern_web' WHEN t LIKE '%public_domain%' THEN 'public_domain' WHEN t LIKE '%institutional%' THEN 'institutions' WHEN t LIKE '%academic%' OR t LIKE '%metadata%' THEN 'academic' ELSE 'other' END AS family FROM (SELECT source_id, {_TYPE_SQL} AS t FROM sources)")
def source_family_ts(a: Archive) -> DataFrame:
    return a.sources.select("source_id", family(source_type(), PAGE_FAMILIES, "other").alias("family"))


@query(f"SELECT source_id, CASE WHEN t = 'academic_metadata' THEN 'B' WHEN source_name LIKE '%5' THEN 'E' WHEN t = 'modern_web' THEN 'C' WHEN t = '' THEN 'attention' ELSE 'C' END AS tier, CASE WHEN t = 'academic_metadata' THEN 'metadata_only_pointer' WHEN t = '' AND source_name NOT LIKE '%5' THEN 'not_source_item_evidence' ELSE 'public_page_traceable' END AS traceability FROM (SELECT source_id, source_name, {_TYPE_SQL} AS t FROM sources)")
def source_tier(a: Archive) -> DataFrame:
    """A tier with its traceability: one struct decides both, so they can't fall apart."""
    both = lambda tier, trace: F.struct(F.lit(tier).alias("tier"), F.lit(trace).alias("traceability"))
    kind = source_type()
    decided = ladder([(kind == "academic_metadata", both("B", "metadata_only_pointer")), (F.endswith("source_name", F.lit("5")), both("E", "public_page_traceable")), (kind == "modern_web", both("C", "public_page_traceable")), (kind == "", both("attention", "not_source_item_evidence"))], both("C", "public_page_traceable"))
    return a.sources.select("source_id", decided.alias("d")).select("source_id", "d.tier", "d.traceability")


#: What each branch of the record classifier gives besides its name.
BRANCHES = [("control", "excluded", "medium", "metadata_only"), ("exclusion", "excluded", "very_high", "suppressed"), ("sensitive", "lead_only", "high", "summary_only"), ("metadata", "lead_only", "low", "metadata_only"), ("narrative", "candidate", "low", "full"), ("pointer", "lead_only", "low", "metadata_only")]
_BRANCH_SQL = "(VALUES ('control','excluded','medium','metadata_only'),('exclusion','excluded','very_high','suppressed'),('sensitive','lead_only','high','summary_only'),('metadata','lead_only','low','metadata_only'),('narrative','candidate','low','full'),('pointer','lead_only','low','metadata_only')) b(branch, analysis_status, sensitivity, display_mode)"


@query(
    f"""WITH c AS (SELECT doc_id, CASE WHEN contains(t, 'licensed under') THEN 'control' WHEN quality = 0 AND toxic = 1 THEN 'exclusion' WHEN toxic = 1 OR contains(t, 'password') THEN 'sensitive' WHEN length(text) < 100 THEN 'metadata' WHEN contains(t, 'tion') THEN 'narrative' ELSE 'pointer' END AS branch,
    concat_ws(',', CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN quality IS NULL THEN 'unlabelled' END) AS flags FROM (SELECT doc_id, text, lower(text) AS t, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)))
    SELECT doc_id, branch, flags, analysis_status, sensitivity, display_mode FROM c LEFT JOIN {_BRANCH_SQL} USING (branch)"""
)
def v2_classify(a: Archive) -> DataFrame:
    """Control, exclusion, sensitivity, metadata, narrative, pointer: the branch by rules, its constants by a table of six rows."""
    d = a.table("documents").join(a.table("labels"), "doc_id", "left").withColumn("t", F.lower("text"))
    branch = ladder([(F.contains("t", F.lit("licensed under")), "control"), ((F.col("quality") == 0) & (F.col("toxic") == 1), "exclusion"), ((F.col("toxic") == 1) | F.contains("t", F.lit("password")), "sensitive"), (F.char_length("text") < 100, "metadata"), (F.contains("t", F.lit("tion")), "narrative")], "pointer")
    flags = F.concat_ws(",", F.when(F.col("toxic") == 1, "toxic"), F.when(F.col("quality").isNull(), "unlabelled"))
    out = described(d.withColumn("flags", flags), branch, BRANCHES, "branch string, analysis_status string, sensitivity string, display_mode string")
    return out.select("doc_id", "branch", "flags", "analysis_status", "sensitivity", "display_mode")


@query("SELECT record_id, location_id, CASE WHEN relation = 'R' AND kind = 'F' THEN 'alleged_event_location' WHEN relation = 'R' THEN 'apparition_location' WHEN kind = 'O' AND priority > 3 THEN 'legend_associated_place' WHEN relation = 'N' THEN 'narrative_setting' ELSE 'uncertain_or_broad_location' END AS role FROM record_places")
def location_role(a: Archive) -> DataFrame:
    r, k = F.col("relation"), F.col("kind")
    role = ladder([((r == "R") & (k == "F"), "alleged_event_location"), (r == "R", "apparition_location"), ((k == "O") & (F.col("priority") > 3), "legend_associated_place"), (r == "N", "narrative_setting")], "uncertain_or_broad_location")
    return a.record_places.select("record_id", "location_id", role.alias("role"))


@query(
    """SELECT conv_id, turn, CASE WHEN regexp_matches(t, 'chance of|out of') THEN 'rejected_idiom' WHEN role = 'assistant' AND n > 600 THEN 'long_answer' WHEN contains(t, 'tion') AND contains(t, 'ment') THEN 'mixed' WHEN contains(t, 'tion') THEN 'narrative' WHEN n < 80 THEN 'fragment' ELSE 'context' END AS class FROM (SELECT conv_id, turn, role, lower(text) AS t, length(text) AS n FROM conversations)"""
)
def classify_block(a: Archive) -> DataFrame:
    c = a.table("conversations").withColumn("t", F.lower("text")).withColumn("n", F.char_length("text"))
    form, scene = F.contains("t", F.lit("tion")), F.contains("t", F.lit("ment"))
    decided = ladder([(mentions(F.col("t"), ["chance of", "out of"]), "rejected_idiom"), ((F.col("role") == "assistant") & (F.col("n") > 600), "long_answer"), (form & scene, "mixed"), (form, "narrative"), (F.col("n") < 80, "fragment")], "context")
    return c.select("conv_id", "turn", decided.alias("class"))


@query("SELECT page_id, CASE WHEN regexp_matches(h, 'idiot|scum|moron') THEN 'noise' WHEN NOT contains(h, 'tion') THEN 'no_context' WHEN contains(url, '?') THEN 'url_parameters' ELSE '' END AS skip_reason FROM (SELECT page_id, url, lower(html) AS h FROM pages)")
def skip_reason(a: Archive) -> DataFrame:
    h = F.lower("html")
    return a.table("pages").select("page_id", ladder([(mentions(h, ["idiot", "scum", "moron"]), "noise"), (~F.contains(h, F.lit("tion")), "no_context"), (F.contains("url", F.lit("?")), "url_parameters")], "").alias("skip_reason"))


@query("SELECT doc_id, CASE WHEN length(text) >= 240 AND ((contains(t, 'tion') AND (contains(t, 'ment') OR contains(source, '1'))) OR contains(t, 'password')) THEN 'review_candidate' ELSE 'weak_lead' END AS status, CAST(contains(t, 'tion') AS INTEGER) + CAST(contains(t, 'able') AS INTEGER) + CAST(contains(t, 'ing') AS INTEGER) AS hits FROM (SELECT doc_id, source, text, lower(text) AS t FROM documents)")
def lead_status(a: Archive) -> DataFrame:
    """Enough text, and a strong term with a person or address, or an entity."""
    d = a.table("documents").withColumn("t", F.lower("text"))
    t = F.col("t")
    strong, person, entity = F.size(hits(t, ["tion"])) > 0, F.size(hits(t, ["ment"])) > 0, F.size(hits(t, ["password"])) > 0
    review = (F.char_length("text") >= 240) & ((strong & (person | F.contains("source", F.lit("1")))) | entity)
    return d.select("doc_id", F.when(review, "review_candidate").otherwise("weak_lead").alias("status"), F.size(hits(t, ["tion", "able", "ing"])).alias("hits"))


@query("SELECT figure_id, CASE WHEN cluster LIKE 'STANDARD%' OR cluster LIKE 'SMALL%' THEN 'everyday' WHEN regexp_matches(cluster, 'BRASS|COPPER') THEN 'metal' WHEN tier > 25 THEN 'large' ELSE 'other' END AS narrative_group FROM figures")
def narrative_group(a: Archive) -> DataFrame:
    c = F.col("cluster")
    return a.figures.select("figure_id", ladder([(c.rlike("^(STANDARD|SMALL)"), "everyday"), (mentions(c, ["BRASS", "COPPER"]), "metal"), (F.col("tier") > 25, "large")], "other").alias("narrative_group"))


@query(r"SELECT doc_id, COALESCE(alias, 'unmatched') AS figure, CASE WHEN alias IS NULL THEN 'lead_only' WHEN toxic = 1 THEN 'requires_review' ELSE 'relevant' END AS relevance FROM documents LEFT JOIN (SELECT doc_id AS d, alias FROM (SELECT doc_id, alias, row_number() OVER (PARTITION BY doc_id ORDER BY pri DESC, length(alias) DESC, alias) AS k FROM documents JOIN (VALUES ('idiot', 2), ('pathetic', 2), ('than', 1)) v(alias, pri) ON regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])' || alias || '($|[^\p{L}\p{N}_])')) WHERE k = 1) m ON m.d = doc_id LEFT JOIN labels USING (doc_id)")
def classify_records(a: Archive) -> DataFrame:
    """The alias of highest priority in each text, then longest, then first in order; figure and relevance from it, in one pass."""
    lexicon = sorted([("idiot", 2), ("pathetic", 2), ("than", 1)], key=lambda x: (-x[1], -len(x[0]), x[0]))
    low = F.lower("text")
    found = F.coalesce(*[F.when(F.contains(low, F.lit(x)) & F.col("text").rlike(r"(?i)(?<![\p{L}\p{N}_])" + x + r"(?![\p{L}\p{N}_])"), x) for x, _ in lexicon])
    d = a.table("documents").select("doc_id", found.alias("alias")).join(a.table("labels"), "doc_id", "left")
    return d.select("doc_id", F.coalesce("alias", F.lit("unmatched")).alias("figure"), ladder([(F.col("alias").isNull(), "lead_only"), (F.col("toxic") == 1, "requires_review")], "relevant").alias("relevance"))


@query("SELECT record_id, CASE level WHEN 'public_page' THEN 'public_heritage_page' WHEN 'restricted_excluded' THEN 'restricted_excluded' ELSE 'open_article' END AS publicness FROM records")
def publicness_code(a: Archive) -> DataFrame:
    level = F.col("level")
    return a.records.select("record_id", ladder([(level == "open_full_text", "open_article"), (level == "public_metadata", "public_metadata"), (level == "public_page", "public_heritage_page"), (level == "restricted_excluded", "restricted_excluded")], "open_article").alias("publicness"))


@query("SELECT CASE WHEN r >= 3500 AND f >= 1200 THEN 'complete' WHEN r >= 3500 THEN 'map_first' WHEN f >= 1200 THEN 'record_growth' ELSE 'balanced_growth' END AS mode, greatest(0, 3500 - r) AS record_gap, greatest(0, 1200 - f) AS map_gap FROM (SELECT (SELECT count(*) FROM public_records) AS r, (SELECT count(DISTINCT record_id) FROM record_places WHERE relation = 'R') AS f)")
def collection_mode(a: Archive) -> DataFrame:
    r = a.public_records.agg(F.count("*").alias("r"))
    f = a.record_places.where("relation = 'R'").agg(F.countDistinct("record_id").alias("f"))
    x, y = F.col("r") >= 3500, F.col("f") >= 1200
    zero = F.lit(0)
    return r.crossJoin(f).select(ladder([(x & y, "complete"), (x, "map_first"), (y, "record_growth")], "balanced_growth").alias("mode"), F.greatest(zero, 3500 - F.col("r")).alias("record_gap"), F.greatest(zero, 1200 - F.col("f")).alias("map_gap"))  # of single rows


@query("SELECT record_id, location_id FROM (SELECT record_id, location_id, row_number() OVER (PARTITION BY record_id ORDER BY CASE state WHEN 'CHINA' THEN 0 WHEN 'INDIA' THEN 1 ELSE 2 END, location_id, priority) AS k FROM record_places JOIN places USING (location_id) WHERE trim(evidence) <> '') WHERE k = 1")
def first_place_wins(a: Archive) -> DataFrame:
    """Of the places that a record's evidence names, the one that comes first in the catalogue."""
    rank = ladder([(F.col("state") == "CHINA", 0), (F.col("state") == "INDIA", 1)], 2)
    j = a.record_places.where("trim(evidence) <> ''").select("record_id", "location_id", "priority").join(a.places.select("location_id", rank.alias("rank")), "location_id")
    return first_by(j, ["record_id"], ["rank", "location_id", "priority"]).select("record_id", "location_id")


#: A lexicon as a table: alias_id, alias, kind, figure, priority.
LEXICON = [(1, "Idiot", "noise_sensitive", "fool", 2), (2, "pathetic", "plain", "mourner", 2), (3, "than", "plain", "giant", 1), (4, "the  of", "historical_descriptor", "title", 3), (5, "und", "plain", "water being", 1), (6, "password", "plain", "keeper", 3)]
_LEXICON_SQL = "(VALUES (1, 'idiot', 'noise_sensitive', 'fool', 2), (2, 'pathetic', 'plain', 'mourner', 2), (3, 'than', 'plain', 'giant', 1), (4, 'the of', 'historical_descriptor', 'title', 3), (5, 'und', 'plain', 'water being', 1), (6, 'password', 'plain', 'keeper', 3)) v(alias_id, alias, kind, figure, priority)"
_MATCHES_SQL = rf"SELECT doc_id, toxic, v.*, length(regexp_extract(c, '(?s)^(|.*?[^\p{{L}}\p{{N}}_])' || alias || '($|[^\p{{L}}\p{{N}}_])', 1)) + 1 AS p FROM (SELECT doc_id, lower(trim(regexp_replace(COALESCE(text, ''), '[\s\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{3000}}]+', ' ', 'g'))) AS c FROM documents) LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) USING (doc_id) JOIN {_LEXICON_SQL} ON regexp_matches(c, '(^|[^\p{{L}}\p{{N}}_])' || alias || '($|[^\p{{L}}\p{{N}}_])')"
_CONFIDENCE_SQL = "CASE WHEN length(alias) <= 4 THEN 'low' WHEN kind IN ('noise_sensitive', 'historical_descriptor') THEN 'medium' ELSE 'high' END"


def _lexicon(a: Archive) -> DataFrame:
    return a.spark.createDataFrame(LEXICON, "alias_id int, alias string, kind string, figure string, priority int")


@query(f"WITH m AS ({_MATCHES_SQL}) SELECT doc_id, alias_id, figure, CAST(p AS INTEGER) AS p, CASE WHEN alias = 'the of' THEN 'medium' ELSE {_CONFIDENCE_SQL} END AS confidence FROM m")
def lexicon_match(a: Archive) -> DataFrame:
    """All aliases of a lexicon table in all texts, as words."""
    return lex.matches(a.table("documents"), _lexicon(a)).select("doc_id", "alias_id", "figure", "p", "confidence")


@query(f"WITH m AS ({_MATCHES_SQL}), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY priority DESC, length(alias) DESC, alias, alias_id) AS k FROM m) WHERE k = 1) SELECT d.doc_id, COALESCE(figure, 'unmatched') AS figure, CASE WHEN figure IS NULL THEN 'lead_only' WHEN l.toxic = 1 THEN 'requires_review' ELSE 'relevant' END AS relevance, CASE WHEN figure IS NULL THEN 'none' ELSE {_CONFIDENCE_SQL} END AS confidence FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id")
def lexicon_classify(a: Archive) -> DataFrame:
    """Figure, relevance and confidence of every text by the best alias of a lexicon table."""
    flags = a.table("labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return lex.classify(a.table("documents").select("doc_id", "text").join(flags, "doc_id", "left"), _lexicon(a), F.col("toxic") == 1)
