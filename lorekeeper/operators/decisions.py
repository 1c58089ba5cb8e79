"""What becomes of leads, hits and candidates. Words, places and rules are parameters; each decision is one expression or one join with a small table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekeeper.functions import text as t
from lorekeeper.operators.ranking import first_by
from lorekeeper.operators.rules import ladder, mentions

#: Texts of fewer characters are no evidence, and bounds of coordinates (fixed values).
SHORT_PAGE, SHORT_SEED = 120, 240
NORTH, SOUTH, WEST, EAST = -8.0, -45.0, 110.0, 160.0


def blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def planned_leads(leads: DataFrame) -> DataFrame:
    """Leads that are planned, public and not blocked as bare words; a missing guard blocks nothing."""
    return leads.where((F.col("collection_action") == "planned_public_query") & (F.col("source_publicness_guard") == "ok_public_source") & ~F.col("high_noise_guard").eqNullSafe(F.lit("BLOCKED_BARE_QUERY")))


def is_bare(query: Column, forbidden: list[str]) -> Column:
    """Whether a query is nothing but a forbidden word, quoted or not."""
    return F.trim(F.regexp_replace(t.normalised(query), "^[\"']+|[\"']+$", "")).isin(*forbidden)


def map_position(x: Column, y: Column, lat: Column, lon: Column, project: Callable[[Column, Column], Column], width: float, height: float) -> Column:
    """struct<x, y>: a flag's own numbers as degrees, else as places of the picture, else its record's coordinates; null without any."""
    told = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    plain = F.struct(x.alias("x"), y.alias("y"))
    return F.when(told & x.between(WEST, EAST) & y.between(SOUTH, NORTH), project(y, x)).when(told & x.between(0, width) & y.between(0, height), plain).when(lat.isNotNull() & lon.isNotNull(), project(lat, lon))


#: What a summary says where a source has no excerpt (a fixed value).
NO_EXCERPT = "The migrated legacy source contains enough public metadata for review, but needs manual excerpt verification."


def summary(title: Column, label: Column, source: Column, snippet: Column, limit: int = 360) -> Column:
    """One sentence on what a source tells, and its first words or a note that they are missing."""
    told = lambda c, other: F.coalesce(F.nullif(c, F.lit("")), F.lit(other))
    evidence = F.coalesce(F.nullif(F.left(F.trim(snippet), F.lit(limit)), F.lit("")), F.lit(NO_EXCERPT))
    return F.format_string("The source reports or discusses %s in '%s' (%s). %s", told(label, "unknown humanoid"), told(title, "Untitled public source"), told(source, "public source"), evidence)


def planned_queries(aliases: DataFrame, rules: DataFrame) -> DataFrame:
    """(alias, query, kind, noise): a noisy alias only with each of its rule's constraints, any other as an exact phrase.

    rules (term, level, constraints) is a configured list, broadcast; a noisy alias without constraints gives no query.
    """
    named = rules.select(t.normalised(F.col("term")).alias("_key"), "level", "constraints")
    j = aliases.select("alias", t.normalised(F.col("alias")).alias("_key")).join(F.broadcast(named), "_key", "left")
    noisy = F.col("constraints").isNotNull()
    asked = F.when(noisy, F.col("constraints")).otherwise(F.array(F.concat(F.lit('"'), "alias", F.lit('"'))))
    noise = F.when(noisy, F.coalesce("level", F.lit("high"))).when(F.char_length("alias") <= 5, "medium").otherwise("low")
    return j.select("alias", F.explode(asked).alias("query"), F.when(noisy, "constrained_boolean").otherwise("exact_phrase").alias("kind"), noise.alias("noise"))


def tier_status(tier: Column, kind: Column, name: Column, discovery: list[str], metadata: list[str]) -> Column:
    """struct<tier, accepted, discovery_only, needs_review> of a source by what its tier, type and name hold."""
    text = F.lower(F.concat_ws(" ", tier, kind, name))
    review = mentions(text, metadata)
    only = mentions(text, discovery)
    return F.struct(F.coalesce(F.nullif(tier, F.lit("")), F.when(review, "metadata").otherwise("unspecified")).alias("tier"), (~only).alias("accepted"), only.alias("discovery_only"), review.alias("needs_review"))


def scope_decision(label: Column, text: Column, rules: list[tuple[list[str], list[str], str]], idioms: list[tuple[list[str], str, str]] = ()) -> Column:
    """struct<keep, reason>: a label of a rule needs one of the rule's words in the text; a label of an idiom must not stand in it; others stay."""
    flat = F.lower(t.collapsed(text))
    kept = F.struct(F.lit(True).alias("keep"), F.lit("").alias("reason"))
    verdict = lambda ok, reason: F.when(ok, kept).otherwise(F.struct(F.lit(False).alias("keep"), F.lit(reason).alias("reason")))
    needs = [(label.isin(*labels), verdict(mentions(flat, words), reason)) for labels, words, reason in rules]
    figures = [(label.isin(*labels), verdict(~flat.rlike(pattern), reason)) for labels, pattern, reason in idioms]
    return ladder(needs + figures, kept)


def choose_result(results: Column, state: Column) -> Column:
    """struct<result, reason>: the first of an array of structs (lat, lon, state, kind) that is in bounds, of the state wanted and no whole state or country."""
    wanted = F.lower(F.trim(F.coalesce(state, F.lit(""))))
    fits = F.filter(results, lambda r: r["lat"].between(SOUTH, NORTH) & r["lon"].between(WEST, EAST) & ((wanted == "") | (F.lower(r["state"]) == wanted)) & ~F.coalesce(F.lower(r["kind"]), F.lit("")).isin("country", "state"))
    found = F.get(fits, 0)
    return F.struct(found.alias("result"), F.when(found.isNotNull(), "accepted").when(F.size(results) > 0, "no_result_matching_state_or_precision").otherwise("no_result").alias("reason"))


def query_variants(place: Column, state: Column, aliases: Column, unplaced: list[str], country: str = "Australia") -> Column:
    """array<struct<query, reason>>: configured names, the place with its state, and the parts of a place of several; each query once, none for what is no place."""
    clean = lambda p: F.when(F.contains(p, state), p).otherwise(F.concat(p, F.lit(", "), state))
    name = F.regexp_replace(t.collapsed(F.translate(place, "’–", "'-")), "^[ ,]+|[ ,]+$", "")
    of = lambda q, reason: F.struct(F.concat(q, F.lit(f", {country}")).alias("query"), F.lit(reason).alias("reason"))
    configured = F.transform(F.coalesce(aliases, F.array().cast("array<string>")), lambda q: of(q, "configured_alias"))
    parts = F.when(F.contains(name, F.lit("/")), F.transform(F.filter(F.split(name, "/"), lambda p: F.trim(p) != ""), lambda p: of(clean(F.trim(p)), "source_text_split"))).otherwise(F.array().cast("array<struct<query:string,reason:string>>"))
    every = F.concat(configured, F.array(of(clean(name), "source_text_cleaned")), parts)
    once = F.aggregate(every, F.array().cast("array<struct<query:string,reason:string>>"), lambda out, x: F.when(F.exists(out, lambda y: y["query"] == x["query"]), out).otherwise(F.array_append(out, x)))
    return F.when(blank(place) | mentions(F.lower(place), unplaced), F.array().cast("array<struct<query:string,reason:string>>")).otherwise(F.filter(once, lambda x: ~F.startswith(F.lower(x["query"]), F.lit("between "))))


def seed_decision(url: Column, text: Column, label: Column, place: Column, editorial: Column, allow_short: Column) -> Column:
    """struct<status, reason> of a seeded page: an address, enough text unless an editor stands in, its label and its place in the text."""
    status = lambda s, reason: F.struct(F.lit(s).alias("status"), F.lit(reason).alias("reason"))
    whole = F.concat(F.lit(" "), F.regexp_replace(t.normalised(F.concat_ws(" ", text, editorial)), r"[^\p{L}\p{N}_]+", " "), F.lit(" "))
    held = lambda term: blank(term) | F.contains(whole, F.concat(F.lit(" "), F.trim(F.regexp_replace(t.normalised(term), r"[^\p{L}\p{N}_]+", " ")), F.lit(" ")))
    short = (F.char_length(t.collapsed(text)) < SHORT_SEED) & ~F.coalesce(allow_short, F.lit(False)) & blank(editorial)
    return ladder([(blank(url), status("rejected", "seed_missing_url")), (short, status("lead_only", "public_text_too_short_for_acceptance")), (~held(label), status("lead_only", "expected_source_label_not_found_in_public_text")), (~held(place), status("lead_only", "expected_place_not_found_in_public_text"))], status("accepted", ""))


def lead_decision(lead_status: Column, label: Column, title: Column, discovery_only: Column, weak: list[str], substantive: list[str]) -> Column:
    """struct<status, reason> of a lead of a page: the first reason that keeps it a lead."""
    status = lambda s, reason: F.struct(F.lit(s).alias("status"), F.lit(reason).alias("reason"))
    lead = lambda reason: status("lead_only", reason)
    return ladder([(discovery_only, lead("tourism_discovery_only")), (label.isin(*weak), lead("weak_or_ambiguous_supernatural_term_requires_manual_review")), (~mentions(F.lower(title), substantive), lead("supernatural_term_only_in_navigation_or_page_boilerplate")), (lead_status != "review_candidate", lead("requires_location_or_source_review"))], status("accepted", ""))


def placed_evidence(pages: DataFrame, places: DataFrame, strong: str, skip: str | None, radius: int = 520) -> DataFrame:
    """(page_id, place, start, end, digest): pages of SHORT_PAGE characters and more at each configured place that their text names as a word.

    The window holds the first mention of the place and the first strong word, radius characters on each
    side (0-based, end exclusive); it must hold a strong word and nothing of skip. Of equal digests, of
    address and window, the first page's stays. places (place, alias) is a configured list, broadcast.
    """
    p = pages.select("page_id", "url", t.collapsed(F.col("text")).alias("text")).where((F.char_length("text") >= SHORT_PAGE) & F.col("text").rlike(strong))
    named = F.expr(r"regexp_instr(text, concat('(?i)\\b\\Q', alias, '\\E\\b'))")
    j = p.join(F.broadcast(places), F.expr("contains(lower(text), lower(alias))")).withColumn("at", named).where("at > 0")
    word = F.char_length(F.regexp_extract("text", strong, 0))
    j = j.withColumn("near", F.regexp_instr("text", F.lit(strong))).withColumn("word", word)
    start = F.greatest(F.lit(0), F.least("at", "near") - 1 - radius)
    end = F.least(F.char_length("text"), F.greatest(F.col("at") - 1 + F.char_length("alias"), F.col("near") - 1 + F.col("word")) + radius)
    j = j.withColumn("start", start).withColumn("end", end).withColumn("evidence", F.expr("substring(text, start + 1, end - start)"))
    j = j.where(F.col("evidence").rlike(strong) & (~F.col("evidence").rlike(skip) if skip else F.lit(True)))
    digest = t.evidence_hash(F.concat_ws(":", "url", "place", "evidence"))
    return first_by(j.select("page_id", "place", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), digest.alias("digest")), ["digest"], ["page_id", "place"])


def first_term_blocks(items: DataFrame, terms: list[str], places: list[str], shortest: int = 90) -> DataFrame:
    """(item_id, block, term, digest): the blocks (lines of ``shortest`` characters and more) of items that name a place, each under its first term alone.

    The place may stand anywhere in the item. The digest is of the item's address and the block, so equal
    blocks of different items differ; of equal ones of an item the first stays.
    """
    named = items.where(mentions(F.lower("text"), places))
    lines = named.select("item_id", "url", F.posexplode(F.filter(F.split("text", "\n"), lambda x: F.char_length(F.trim(x)) >= shortest)).alias("at", "line"))
    term = F.coalesce(*[F.when(F.contains(F.lower("line"), F.lit(x)), x) for x in terms])
    found = lines.select("item_id", (F.col("at") + 1).cast("long").alias("block"), term.alias("term"), t.evidence_hash(F.concat_ws(":", "url", "line")).alias("digest")).where("term is not null")
    return first_by(found, ["item_id", "digest"], ["block"])


def candidate_rows(df: DataFrame, fields: list[str], given: dict[str, Column], defaults: dict[str, str]) -> DataFrame:
    """df as candidates: every field in its order, given, else its default, else empty; all as text."""
    return df.select(*[F.coalesce(given.get(f, F.lit(None)).cast("string"), F.lit(defaults.get(f, ""))).alias(f) for f in fields])


def regional_signal(text: Column, signals: list[str], misleading: str, decisive: list[str]) -> Column:
    """Whether a text tells of the region: by any signal; where a misleading word stands in it, by a decisive one alone."""
    flat = t.normalised(text)
    return F.when(flat.rlike(rf"\b{misleading}\b"), mentions(flat, decisive)).otherwise(mentions(flat, signals))


def only_promotion(role: Column, source: Column, host: Column, names: list[str], hosts: list[str]) -> Column:
    """Whether a candidate stems from promotion alone: by its role, or by parts of its source's name or host."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return F.contains(low(role), F.lit("tourism")) | mentions(low(source), names) | mentions(low(host), hosts)


def until_met(step: Callable[[int], bool], met: Callable[[], bool], passes: int | None = None) -> int:
    """Runs passes until the targets are met, a pass finds nothing new, or their number is reached; how many ran."""
    done = 0
    while not met() and (passes is None or done < passes):
        done += 1
        if not step(done):
            break
    return done


def check_rows(parts: dict[str, DataFrame]) -> DataFrame:
    """(check_name, failures, passed): one count for each frame of offending rows."""
    rows = [df.agg(F.count("*").alias("failures")).select(F.lit(name).alias("check_name"), "failures", (F.col("failures") == 0).alias("passed")) for name, df in parts.items()]
    return reduce(DataFrame.unionAll, rows)
