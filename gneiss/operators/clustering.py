"""Name clusters and portfolio groups: blocked similarity or shared keys, then connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gneiss.config import Settings
from gneiss.functions.fixed import MAILING_CONTACTS
from gneiss.functions.names import entity_id, truth
from gneiss.functions.similarity import name_similarity
from gneiss.operators.components import connected_components
from gneiss.operators.lineage import cut
from gneiss.operators.versions import first_by


def cluster_names(names: DataFrame, settings: Settings | None = None, extra_edges: DataFrame | None = None) -> dict[str, DataFrame]:
    """assignment(name, is_org, canonical), evidence and review of names(name, is_org, weight).

    Names of one kind and first word are compared unless there are more than
    the cap of them; pairs over the automatic threshold merge, those between
    the thresholds are queued. extra_edges(name_a, name_b, score, method) merge
    too where both names exist in one kind. A cluster is called by its heaviest
    name, then the shortest, then the first.
    """
    s = settings or Settings()
    seen = cut(names.groupBy("name", "is_org").agg(F.sum("weight").alias("weight")))
    block = seen.select("name", "is_org", F.split("name", " ")[0].alias("word"))
    sizes = block.groupBy("is_org", "word").count().where(F.col("count").between(2, s.max_block_size)).select("is_org", "word")
    members = block.join(sizes, ["is_org", "word"])
    a, b = members.withColumnRenamed("name", "name_a"), members.withColumnRenamed("name", "name_b")
    pairs = a.join(b, ["is_org", "word"]).where("name_a < name_b").drop("word")
    scored = pairs.withColumn("score", name_similarity(F.col("name_a"), F.col("name_b"), F.col("is_org"))).where(F.col("score") >= s.name_review_threshold)
    scored = cut(scored.withColumns({"method": F.lit("name_fuzzy"), "decision": F.when(F.col("score") >= s.name_auto_threshold, "auto").otherwise("review"), "score": F.round("score", 4)}))
    evidence = scored.where("decision = 'auto'")
    if extra_edges is not None:
        kinds = extra_edges.join(seen.select(F.col("name").alias("name_a"), "is_org"), "name_a").join(seen.select(F.col("name").alias("name_b"), "is_org"), ["name_b", "is_org"])
        evidence = evidence.unionByName(kinds.select("is_org", "name_a", "name_b", F.round("score", 4).alias("score"), "method", F.lit("auto").alias("decision")))
    evidence = cut(evidence)
    node = lambda c: F.concat(F.when(F.col("is_org"), "1|").otherwise("0|"), F.col(c))
    parts = connected_components(evidence.select(node("name_a").alias("src"), node("name_b").alias("dst")))
    placed = seen.withColumn("node", node("name")).join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    heads = first_by(placed, ["component"], F.col("weight").desc(), F.length("name"), F.col("name")).select("component", F.col("name").alias("canonical"))
    return {"assignment": placed.join(heads, "component").select("name", "is_org", "canonical"), "evidence": evidence, "review": scored.where("decision = 'review'")}


def resolve_owners(permits: DataFrame, map_permits: DataFrame, properties: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """owners, map_property_owners, owner_name_map, owner_matches and owner_review_queue of permit and lot owners."""
    p = permits.where("dup_rank = 1 and owner_name is not null").select("permit_row_id", "owner_name", "owner_is_org").join(map_permits, F.col("permit_row_id") == F.col("source_record_id"))
    p = p.groupBy(F.col("owner_name").alias("name"), F.col("owner_is_org").alias("is_org"), "property_id").agg(F.count("*").alias("n_records")).withColumn("source", F.lit("permits"))
    lots = properties.where("pluto_owner_name is not null and in_pluto")
    lots = lots.select(F.col("pluto_owner_name").alias("name"), F.col("pluto_owner_is_org").alias("is_org"), "property_id", F.greatest("n_source_records", F.lit(1)).alias("n_records"), F.lit("pluto").alias("source"))
    mention = cut(p.unionByName(lots))
    found = cluster_names(mention.select("name", "is_org", F.col("n_records").alias("weight")), settings)
    named = cut(mention.join(found["assignment"], ["name", "is_org"]).withColumn("owner_id", entity_id("O", F.col("canonical"), truth(F.col("is_org")))))
    owners = named.groupBy("owner_id", F.col("canonical").alias("canonical_owner_name"), F.col("is_org").alias("owner_is_org")).agg(
        F.count_distinct("name").alias("n_name_variants"), F.count_distinct("property_id").alias("n_properties"), F.sum("n_records").alias("n_records")
    )
    links = named.groupBy("property_id", "owner_id", F.col("source").alias("relation")).agg(F.sum("n_records").alias("evidence_records"))
    return {"owners": owners, "map_property_owners": links, "owner_name_map": named.select("name", "is_org", "owner_id").distinct(), "owner_matches": found["evidence"], "owner_review_queue": found["review"]}


def phone_edges(licences: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Pairs of business names that share a phone (of at most the capped number of names) and are alike, but not enough to merge by name."""
    s = settings or Settings()
    names = licences.where("contact_phone is not null and business_name is not null").select("contact_phone", "business_name").distinct()
    few = names.groupBy("contact_phone").count().where(F.col("count").between(2, s.max_phone_group)).select("contact_phone")
    kept = names.join(few, "contact_phone")
    pairs = kept.withColumnRenamed("business_name", "name_a").join(kept.withColumnRenamed("business_name", "name_b"), "contact_phone").where("name_a < name_b")
    pairs = pairs.select("name_a", "name_b").distinct().withColumn("score", name_similarity(F.col("name_a"), F.col("name_b"), F.lit(True)))
    return cut(pairs).where((F.col("score") >= s.phone_threshold) & (F.col("score") < s.name_auto_threshold)).withColumn("method", F.lit("phone+name"))


def resolve_businesses(licences: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """businesses, map_license_business, business_matches and business_review_queue of licences."""
    rows = licences.where("business_name is not null").select("license_id", "business_name", "contact_phone")
    weights = rows.groupBy(F.col("business_name").alias("name")).agg(F.count("*").alias("weight")).withColumn("is_org", F.lit(True))
    found = cluster_names(weights, settings, phone_edges(rows, settings))
    named = rows.join(found["assignment"], F.col("business_name") == F.col("name")).withColumn("business_id", entity_id("B", F.col("canonical"), truth(F.lit(True))))
    named = cut(named)
    businesses = named.groupBy("business_id", F.col("canonical").alias("canonical_business_name")).agg(F.count_distinct("license_id").alias("n_licenses"), F.count_distinct("business_name").alias("n_name_variants"))
    return {"businesses": businesses, "map_license_business": named.select("license_id", "business_id").distinct(), "business_matches": found["evidence"], "business_review_queue": found["review"]}


def star_edges(members: DataFrame, key: str, node: str, cap: int) -> DataFrame:
    """From the smallest node of each key to its others; keys of one node or more than `cap` give none."""
    pairs = members.where(F.col(key).isNotNull() & F.col(node).isNotNull()).select(key, node).distinct()
    hubs = pairs.groupBy(key).agg(F.min(node).alias("hub"), F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= cap))
    return pairs.join(hubs, key).where(F.col(node) != F.col("hub")).select(F.col("hub").alias("src"), F.col(node).alias("dst"), F.col(key).alias("edge_key"))


def portfolio_groups(contacts: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """property_owner_group, owner_groups and owner_group_evidence of contacts(property_id, contact_type, corporation_name, mailing_key).

    Properties share a group when they share a corporation's name, or an
    owner's mailing address. The label is the most frequent corporation of the
    group, the first by name of equals. A group's id comes from its smallest
    property.
    """
    s = settings or Settings()
    corp = star_edges(contacts, "corporation_name", "property_id", s.corp_fanout).withColumn("edge_type", F.lit("corp_name"))
    mail = star_edges(contacts.where(F.col("contact_type").isin(MAILING_CONTACTS)), "mailing_key", "property_id", s.mailing_fanout).withColumn("edge_type", F.lit("mailing_address"))
    edges = cut(corp.unionByName(mail))
    parts = connected_components(edges)
    members = contacts.where("property_id is not null").select("property_id").distinct().join(parts, F.col("property_id") == F.col("node"), "left")
    members = cut(members.select("property_id", entity_id("G", F.coalesce("component", "property_id")).alias("group_id")))
    counts = contacts.where("corporation_name is not null").join(members, "property_id").groupBy("group_id", "corporation_name").count()
    labels = first_by(counts, ["group_id"], F.col("count").desc(), F.col("corporation_name")).select("group_id", F.col("corporation_name").alias("group_label"))
    groups = members.groupBy("group_id").agg(F.count("*").alias("n_properties")).join(labels, "group_id", "left")
    evidence = edges.select(F.col("src").alias("property_a"), F.col("dst").alias("property_b"), "edge_type", F.substring("edge_key", 1, 120).alias("edge_key"))
    return {"property_owner_group": members, "owner_groups": groups, "owner_group_evidence": evidence}


def mode(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """The most frequent non-null value of each key, the smallest of equals."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(value))
    return counts.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(*keys, F.col(value).alias(out))
