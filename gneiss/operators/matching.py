"""Property resolution: a cascade of exact joins, blocked scoring and minted ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gneiss.config import Settings
from gneiss.functions.names import entity_id
from gneiss.functions.similarity import haversine, token_sort_ratio
from gneiss.operators.lineage import cut
from gneiss.operators.versions import first_by

ADDRESS_KEYS = ["house_number", "street_name", "street_suffix", "borough", "zipcode", "bbl", "normalized_address"]


def mentions(**sources: DataFrame) -> DataFrame:
    """Distinct address mentions of each source, with mean coordinates, record counts and a stable id."""
    out = None
    for source, rows in sources.items():
        kept = rows.where(F.col("normalized_address").isNotNull() | F.col("bbl").isNotNull())
        part = kept.groupBy(*ADDRESS_KEYS).agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"), F.count("*").alias("n_records"))
        part = part.withColumn("source", F.lit(source))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("mention_id", F.sha1(F.to_json(F.struct("source", *ADDRESS_KEYS))))


def block_members(reference: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Reference rows of blocks that have every key and at most `cap` members; the count is made before any member meets another."""
    sized = reference.where(F.col(keys[0]).isNotNull() & F.col(keys[1]).isNotNull())
    counts = sized.groupBy(*keys).agg(F.count("*").alias("block_size")).where(F.col("block_size") <= cap)
    return sized.join(counts, keys)


def pair_score(street: Column, left: str, right: str, s: Settings) -> Column:
    """The weighted score of two address rows, given as column prefixes, to four digits."""
    def of(c: str) -> tuple[Column, Column]:
        return F.col(left + c), F.col(right + c)

    za, zb = of("zipcode")
    zips = F.when(za.isNull() | zb.isNull(), 0.5).when(za == zb, 1.0).otherwise(0.0)
    (ya, yb), (xa, xb) = of("latitude"), of("longitude")
    far = haversine(ya, xa, yb, xb)
    near = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (s.geo_zero_credit_m - far) / (s.geo_zero_credit_m - s.geo_full_credit_m)))
    geo = F.when(far.isNotNull(), F.round(near, 4)).otherwise(0.5)
    fa, fb = of("street_suffix")
    suffix = F.when(fa.eqNullSafe(fb), 1.0).when(fa.isNull() | fb.isNull(), 0.5).otherwise(0.0)
    return F.round(s.weight_street * F.round(street, 4) + s.weight_zip * zips + s.weight_geo * geo + s.weight_suffix * suffix, 4)


def match_properties(mention: DataFrame, reference: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """matches, review and counters of mentions against reference lots (bbl unique).

    Passes: equal lot; equal borough and address (of several lots the largest
    number); the best score of the block (borough, house number), ties to the
    smallest lot, blocks over the cap skipped; minted ids for the rest, those
    in the review band included.
    """
    s = settings or Settings()
    base = mention.select("mention_id", "source", "n_records", *ADDRESS_KEYS, "latitude", "longitude")
    lots = reference.select(F.col("bbl").alias("lot"))
    by_lot = base.where("bbl is not null").join(lots, F.col("bbl") == F.col("lot"), "left")
    by_lot = by_lot.select(*base.columns, F.concat(F.lit("P"), "bbl").alias("property_id"), F.when(F.col("lot").isNotNull(), "bbl_exact").otherwise("bbl_standalone").alias("match_method"), F.lit(1.0).alias("match_score"))
    left = base.where("bbl is null and normalized_address is not null")
    addresses = reference.where("borough is not null and normalized_address is not null").groupBy("borough", "normalized_address").agg(F.max("bbl").alias("lot"))
    found = cut(left.join(addresses, ["borough", "normalized_address"], "left"))
    by_address = found.where("lot is not null").select(*base.columns, F.concat(F.lit("P"), "lot").alias("property_id"), F.lit("address_exact").alias("match_method"), F.lit(1.0).alias("match_score"))
    open_ = found.where("lot is null").drop("lot")
    blocks = block_members(reference, ["borough", "house_number"], s.max_block_size)
    side = blocks.select("borough", "house_number", F.col("bbl").alias("lot"), *[F.col(c).alias(f"r_{c}") for c in ("street_name", "street_suffix", "zipcode", "latitude", "longitude")])
    pairs = open_.join(side, ["borough", "house_number"])
    # the street ratio runs once for each pair of different names
    names = pairs.select(F.coalesce("street_name", F.lit("")).alias("a"), F.coalesce("r_street_name", F.lit("")).alias("b")).distinct()
    ratios = names.select("a", "b", token_sort_ratio("a", "b").alias("street"))
    scored = pairs.join(ratios, (F.coalesce("street_name", F.lit("")) == F.col("a")) & (F.coalesce("r_street_name", F.lit("")) == F.col("b")))
    scored = scored.withColumn("score", pair_score(F.col("street"), "", "r_", s))
    best = cut(first_by(scored, ["mention_id"], F.col("score").desc(), F.col("lot")))
    fuzzy = best.where(F.col("score") >= s.auto_match_threshold).select(*base.columns, F.concat(F.lit("P"), "lot").alias("property_id"), F.lit("fuzzy").alias("match_method"), F.col("score").alias("match_score"))
    review = best.where((F.col("score") >= s.review_threshold) & (F.col("score") < s.auto_match_threshold))
    alone = open_.join(fuzzy.select("mention_id"), "mention_id", "left_anti")
    alone = alone.select(*base.columns, entity_id("PX", F.col("borough"), F.col("normalized_address")).alias("property_id"), F.lit("standalone").alias("match_method"), F.lit(0.0).alias("match_score"))
    matches = by_lot.unionByName(by_address).unionByName(fuzzy).unionByName(alone)
    right = reference.count()
    n_open, compared = open_.count(), pairs.count()
    naive = n_open * right
    counters = {"naive_pairs": naive, "compared_pairs": compared, "reduction_pct": round(100 * (1 - compared / naive), 4) if naive else 0.0}
    keyed = open_.where("borough is not null and house_number is not null")
    over = reference.groupBy("borough", "house_number").count().where(F.col("count") > s.max_block_size)
    counters |= {"missing_block_key": n_open - keyed.count(), "oversize_skips": keyed.join(over, ["borough", "house_number"], "left_semi").count()}
    return {"matches": matches, "review": review.select("mention_id", F.col("lot").alias("candidate_bbl"), F.col("score").alias("match_score")), "counters": counters}


def properties(matches: DataFrame, reference: DataFrame) -> DataFrame:
    """One row for each property: the lot's attributes where it has one, else its mentions' (the smallest of each)."""
    m = matches.groupBy("property_id").agg(
        F.min("bbl").alias("m_bbl"), F.min("normalized_address").alias("m_address"), F.min("borough").alias("m_borough"), F.min("zipcode").alias("m_zip"),
        F.sum("n_records").alias("n_source_records"), F.count("*").alias("n_mentions"),
    )
    r = reference.select([F.col(c).alias(f"r_{c}") for c in reference.columns])
    out = m.join(r, F.expr("replace(property_id, 'P', '')") == F.col("r_bbl"), "left")
    number = F.regexp_extract("m_address", "^([0-9][0-9A-Z-]*)", 1)
    return out.select(
        "property_id", F.coalesce("r_bbl", "m_bbl").alias("bbl"), F.coalesce("r_normalized_address", "m_address").alias("canonical_address"),
        F.coalesce("r_house_number", number).alias("house_number"), F.col("r_street_name").alias("street_name"), F.coalesce("r_borough", "m_borough").alias("borough"),
        F.coalesce("r_zipcode", "m_zip").alias("zipcode"), F.col("r_latitude").alias("latitude"), F.col("r_longitude").alias("longitude"),
        F.col("r_units_res").alias("units_res"), F.col("r_units_total").alias("units_total"), F.col("r_owner_name").alias("pluto_owner_name"),
        F.col("r_owner_is_org").alias("pluto_owner_is_org"), F.col("r_year_built").alias("year_built"), F.col("r_bldg_class").alias("bldg_class"),
        F.col("r_bbl").isNotNull().alias("in_pluto"), "n_mentions", "n_source_records",
    )


def record_map(records: DataFrame, record_key: str, source: str, mention: DataFrame, matches: DataFrame) -> DataFrame:
    """Every source record with its property: a null-safe join on the six address keys."""
    keys = ADDRESS_KEYS[:6]
    m = mention.where(F.col("source") == source).select("mention_id", *[F.col(k).alias(f"m_{k}") for k in keys], F.col("normalized_address").alias("m_normalized_address"))
    on = F.lit(True)
    for k in [*keys, "normalized_address"]:
        on = on & F.col(k).eqNullSafe(F.col(f"m_{k}"))
    joined = records.join(m, on).join(matches.select("mention_id", "property_id", "match_method", "match_score"), "mention_id")
    return joined.select(F.col(record_key).alias("source_record_id"), "property_id", "match_method", "match_score")


def method_histogram(matches: DataFrame) -> DataFrame:
    return matches.groupBy("match_method").agg(F.count("*").alias("mentions"), F.sum("n_records").alias("records"))


def blinded_outcomes(mention: DataFrame, reference: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(mention_id, band, strict, building) of mentions whose known lot is hidden and matched again by address.

    strict: the same lot; building: a lot of the same borough and address.
    Bands are address_exact, fuzzy, review, unmatched and no_address.
    """
    s = settings or Settings()
    lots = reference.select("bbl", "borough", "normalized_address")
    known = mention.where("bbl is not null").join(lots.select("bbl"), "bbl", "left_semi")
    result = match_properties(known.withColumn("bbl", F.lit(None).cast("string")), reference, s)
    got = result["matches"].where("match_method in ('address_exact', 'fuzzy')").select("mention_id", F.expr("substr(property_id, 2)").alias("lot"), F.col("match_method").alias("band"))
    queued = result["review"].select("mention_id", F.col("candidate_bbl").alias("lot"), F.lit("review").alias("band"))
    side = lambda x: lots.select([F.col(c).alias(f"{x}_{c}") for c in lots.columns])
    rows = known.select("mention_id", F.col("bbl").alias("truth"), F.col("normalized_address").isNull().alias("blank")).join(got.unionByName(queued), "mention_id", "left")
    rows = rows.join(side("t"), F.col("truth") == F.col("t_bbl")).join(side("g"), F.col("lot") == F.col("g_bbl"), "left")
    building = (F.col("g_borough") == F.col("t_borough")) & (F.col("g_normalized_address") == F.col("t_normalized_address"))
    band = F.when(F.col("blank"), "no_address").otherwise(F.coalesce("band", F.lit("unmatched")))
    return rows.select("mention_id", band.alias("band"), F.coalesce(F.col("lot") == F.col("truth"), F.lit(False)).alias("strict"), F.coalesce(building, F.lit(False)).alias("building"))


def blinded_evaluation(outcomes: DataFrame) -> DataFrame:
    """Each band's outcomes: how many, how many right, and precisions by lot and by building."""
    out = outcomes.groupBy("band").agg(F.count("*").alias("n"), F.count_if("strict").alias("strict_correct"), F.count_if("building").alias("building_correct"))
    matched = F.col("band").isin("address_exact", "fuzzy", "review")
    return out.withColumns({f"precision_{k}": F.when(matched, F.round(F.col(f"{k}_correct") / F.col("n"), 4)) for k in ("strict", "building")}).orderBy("band")


def blinded_measures(outcomes: DataFrame) -> DataFrame:
    """One row over all bands: the review band counts as not matched, mentions without an address not at all."""
    auto = F.col("band").isin("address_exact", "fuzzy")
    c = outcomes.agg(
        F.count_if(F.col("band") != "no_address").alias("eval_n"), F.count_if(F.col("band") == "no_address").alias("excluded_no_address"), F.count_if(F.col("band") == "unmatched").alias("unmatched"),
        F.count_if(auto & F.col("strict")).alias("tp"), F.count_if(auto & ~F.col("strict")).alias("fp"),
    )
    rate = lambda x, y: F.round(x / F.nullif(y, F.lit(0)), 4)
    tp, fp, n = F.col("tp"), F.col("fp"), F.col("eval_n")
    return c.withColumns({"precision_strict": rate(tp, tp + fp), "recall_strict": rate(tp, n), "false_positive_rate": rate(fp, n), "false_negative_rate": rate(n - tp - fp, n)})


def name_evaluation(pairs: DataFrame, similarity: Column, settings: Settings | None = None) -> DataFrame:
    """One row of confusion counts and rates for labelled pairs(label, ...): 1 is a match."""
    s = settings or Settings()
    rows = pairs.withColumn("score", similarity).withColumn("auto", F.col("score") >= s.name_auto_threshold)
    c = rows.agg(
        F.count_if(F.col("auto") & (F.col("label") == 1)).alias("tp"), F.count_if(F.col("auto") & (F.col("label") == 0)).alias("fp"),
        F.count_if(~F.col("auto") & (F.col("label") == 1)).alias("fn"), F.count_if(~F.col("auto") & (F.col("label") == 0)).alias("tn"),
        F.count_if((F.col("score") >= s.name_review_threshold) & ~F.col("auto")).alias("review"),
    )
    rate = lambda x, y: F.col(x) / F.nullif(F.col(x) + F.col(y), F.lit(0))
    return c.withColumns({"precision": rate("tp", "fp"), "recall": rate("tp", "fn"), "fpr": rate("fp", "tn"), "f1": 2 * F.col("tp") / F.nullif(2 * F.col("tp") + F.col("fp") + F.col("fn"), F.lit(0))})


