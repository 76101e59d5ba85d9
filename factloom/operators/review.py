"""Reviews of tables: constraint checks, audits, named gates, strict matches, funnels, summaries, work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.text import city_key, norm_name, place_number, place_words, zip5

# Names that are not this trade by category, first match first, and signals that they may be all the same.
NOT_OURS = [
    ("doors_windows", r"\bmasonite\b|\bjeld[\s\-]?wen\b|\bandersen\s+window|\banderson\s+window|\bpella\b|\bmarvin\s+window"),
    ("commodity_panel", r"\blouisiana[\s\-]pacific\b|\bgeorgia[\s\-]?pacific\b|\bweyerhaeuser\b|\bplywoods?\b|\bveneers?\b|\bparticle\s*boards?\b|\bosb\b"),
    ("millwork", r"\bmillworks?\b|\bmouldings?\b|\bmoldings?\b|\bcabinet(ry|s)?\b|\bcountertop"),
    ("pallets_crates", r"\bpallets?\b|\bcrating\b|\bcrates?\b"),
    ("concrete_supply", r"\bready[\s\-]?mix\b|\bredi[\s\-]?mix\b|\baggregates?\b"),
    ("infrastructure", r"\bculverts?\b|\bseptic\b|\bburial\s+vaults?\b|\bconcrete\s+pipes?\b"),
]
SIGNALS = r"\btruss(es)?\b|\bmodular\b|\bmanufactured\s+hom|\bmobile\s+hom|\bprefab|\bpre[\s\-]?engineered\b|\bpanelized\b|\bpanelised\b|\bwall\s+panel|\bfloor\s+panel|\broof\s+panel|\bsip\b|\bglulam\b|\bcross[\s\-]laminated\b|\bmass\s+timber\b|\bmetal\s+building|\bbuilding\s+systems?\b"
PRODUCT_NAICS = ["321911", "321918", "321912", "321219", "321211", "321212", "321920"]
# The bases on which a coordinate may stand, and the fields of a capability.
POINT_BASES = ["rooftop", "place_match", "interpolated_on_building"]


def problems(rows: DataFrame, required: list[str], unique: list[str], allowed: dict[str, list[str]], paired: list[tuple[str, str]] = ()) -> DataFrame:
    """(check, n) of a control table: blank required cells, keys in several rows, values out of a list, halves of pairs.

    One pass over the rows and, for the keys, one aggregation by key.
    """
    full = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != ""
    checks = {f"blank:{c}": ~full(c) for c in required} | {f"value:{c}": full(c) & ~F.col(c).isin(v) for c, v in allowed.items()} | {f"pair:{a}+{b}": full(a) != full(b) for a, b in paired}
    counts = rows.agg(*[F.count_if(x).alias(n) for n, x in checks.items()]).unpivot([], list(checks), "check", "n") if checks else None
    several = rows.groupBy(*unique).agg(F.count("*").alias("k")).where("k > 1").agg(F.count("*").alias("n")).select(F.lit(f"repeated:{'+'.join(unique)}").alias("check"), "n")
    return (several if counts is None else counts.unionByName(several)).where("n > 0")


def totals(rows: DataFrame, by: str, amount: str, stated: DataFrame) -> DataFrame:
    """(by, stated, found) where a control table's parts do not add up to its stated total. stated: (by, total)."""
    found = rows.groupBy(by).agg(F.sum(amount).alias("found"))
    return stated.withColumnRenamed("total", "stated").join(found, by, "full").where(~F.col("stated").eqNullSafe(F.col("found"))).select(by, "stated", "found")


def not_ours(name: Column) -> Column:
    """The first category of names that are not this trade, or null."""
    low = F.lower(name)
    out = F.lit(None).cast("string")
    for category, pattern in reversed(NOT_OURS):
        out = F.when(low.rlike(pattern), category).otherwise(out)
    return out


def precision_audit(rows: DataFrame) -> DataFrame:
    """(product_type, admitted, flagged, held_back, product_naics): admitted names that read as another trade. rows: (name, product_type, naics).

    A name that also carries a signal of this trade is held back, not counted. The two rates bracket the truth.
    """
    marked = rows.where(F.coalesce("name", F.lit("")) != "").withColumns({"no": not_ours(F.col("name")), "yes": F.lower("name").rlike(SIGNALS)})
    return marked.groupBy("product_type").agg(
        F.count("*").alias("admitted"), F.count_if(F.col("no").isNotNull() & ~F.col("yes")).alias("flagged"), F.count_if(F.col("no").isNotNull() & F.col("yes")).alias("held_back"), F.count_if(F.col("naics").isin(PRODUCT_NAICS)).alias("product_naics")
    )


def evidence_gates(facts: DataFrame, groups: list[str], leaves: list[str]) -> DataFrame:
    """(gate, n, bad) of the gates on how facts cite their evidence, in one pass. facts: (source_id, field, value, basis, evidence)."""
    has = lambda s: F.contains(F.coalesce("evidence", F.lit("")), F.lit(s))
    field, basis, source = F.col("field"), F.coalesce("basis", F.lit("")), F.col("source_id")
    gates = {
        "E1": (source == "enrich:locate", ~has("::") | ~F.coalesce("evidence", F.lit("")).startswith("http")),
        "E2": (field == "lat_lon", ~basis.isin(POINT_BASES)),
        "E3": (field == "building_sqft", ~has(":")),
        "E5": (source == "enrich:existence", (field != "existence_flag") | (F.coalesce("value", F.lit("")) != "review")),
        "E7": (basis == "place_match", ~has("overture:") | ~has(":: matched ")),
        "E8": (basis == "interpolated_on_building", ~has("building:") | ~has("confirmed by")),
        "E9": (field.isin("capability_group", "capability_leaf"), ~F.when(field == "capability_leaf", F.col("value").isin(leaves)).otherwise(F.col("value").isin(groups))),
    }
    one = facts.agg(*[F.struct(F.count_if(a).alias("n"), F.count_if(a & F.coalesce(b, F.lit(True))).alias("bad")).alias(g) for g, (a, b) in gates.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(g).alias("gate"), F.col(f"{g}.n").alias("n"), F.col(f"{g}.bad").alias("bad")) for g in gates])))


def lost_coverage(before: DataFrame, after: DataFrame, fields: list[str], allowed: dict[str, int] | None = None) -> DataFrame:
    """(field, before, after) where fewer rows hold a field than before, less what is allowed: gates E4 and E6."""
    held = lambda df, n: df.agg(*[F.count_if(F.trim(F.coalesce(F.col(f).cast("string"), F.lit(""))) != "").alias(f) for f in fields]).unpivot([], fields, "field", n)
    spare = F.create_map(*[F.lit(x) for kv in ({"": 0} | (allowed or {})).items() for x in kv])
    return held(before, "before").join(held(after, "after"), "field").where(F.col("after") < F.col("before") - F.coalesce(F.element_at(spare, F.col("field")), F.lit(0)))


def strict_places(entities: DataFrame, places: DataFrame, score, least: float = 0.90) -> DataFrame:
    """(id, place_id, how): the place of one number, word set, city, state, ZIP where both have one, and name.

    entities: (id, name, address, city, state, zip); places: (place_id, name, address, city, state, zip, lat, lon). Several
    matching places count only if they are one point to five places; then the best name, the larger id in a tie, stands.
    """

    def keyed(df, p):
        words = F.array_join(F.sort_array(place_words(F.col("address"))), " ")
        return df.select(*[F.col(c).alias(f"{p}{c}") for c in df.columns], F.concat_ws("|", place_number(F.col("address")), words, F.upper(F.trim("city")), F.upper(F.trim("state"))).alias(f"{p}k"), place_number(F.col("address")).alias(f"{p}no"), words.alias(f"{p}w"))

    e, q = keyed(entities, "e_").where("e_no <> '' and e_w <> ''"), keyed(places, "q_")
    ez, qz = zip5(F.col("e_zip")), zip5(F.col("q_zip"))
    near = e.join(q, F.col("e_k") == F.col("q_k")).where((ez == "") | (qz == "") | (ez == qz)).withColumn("s", score("e_name", "q_name")).where(F.col("s") >= least)
    point = F.struct(F.round("q_lat", 5), F.round("q_lon", 5))
    found = near.groupBy("e_id").agg(F.min(point).alias("p0"), F.max(point).alias("p1"), F.max(F.struct("s", F.col("q_place_id").alias("place_id"))).alias("best"))
    one = F.col("p0") == F.col("p1")
    return found.select(F.col("e_id").alias("id"), F.when(one, F.col("best.place_id")).alias("place_id"), F.when(one, "matched").otherwise("ambiguous_place_points").alias("how"))


def settled_places(candidates: DataFrame, near_m: float = 150.0, least: float = 0.90) -> DataFrame:
    """(id, place_id, how) among several places at an address. candidates: (id, place_id, name, lat, lon, score).

    One candidate stands; several within near_m of each other are one building, of which the first by name and point
    stands; else the best name stands if it scores `least`.
    """
    box = candidates.groupBy("id").agg(
        F.count("*").alias("n"), F.min("lat").alias("a0"), F.max("lat").alias("a1"), F.min("lon").alias("o0"), F.max("lon").alias("o1"),
        F.min(F.struct(F.coalesce("name", F.lit("")).alias("name"), "lat", "lon", "place_id")).alias("first"), F.max(F.struct("score", F.struct((-F.col("place_id")).alias("x")).alias("y"), "place_id")).alias("best"),
    )
    metre = 111_195.0
    spread = F.sqrt(F.pow((F.col("a1") - F.col("a0")) * metre, 2) + F.pow((F.col("o1") - F.col("o0")) * metre * F.cos(F.radians("a0")), 2))
    how = F.when(F.col("n") == 1, "one").when(spread <= near_m, "one_building").when(F.col("best.score") >= least, "name").otherwise("ambiguous")
    return box.withColumn("how", how).select("id", F.when(F.col("how").isin("one", "one_building"), F.col("first.place_id")).when(F.col("how") == "name", F.col("best.place_id")).alias("place_id"), "how")


def sole_donor(targets: DataFrame, givers: DataFrame, key: Column) -> DataFrame:
    """(id, donor, point, how) for every target with a key: the one other entity of that key, if its points agree.

    targets: (id, …); givers: (id, point, …). One aggregation of the givers by key, and one of those that a target may be itself.
    """
    t = targets.select("id", key.alias("k")).where("k <> ''")
    g = givers.select(F.col("id").alias("g"), "point", key.alias("k")).where("k <> ''").groupBy("k", "g").agg(F.min("point").alias("p0"), F.max("point").alias("p1"))
    found = t.join(g, "k", "left").where(F.col("g").isNull() | (F.col("g") != F.col("id"))).groupBy("id").agg(F.count("g").alias("n"), F.min("g").alias("g"), F.min("p0").alias("p0"), F.max("p1").alias("p1"))
    out = t.join(found, "id", "left")
    how = F.when(F.coalesce("n", F.lit(0)) == 0, "no_donor").when(F.col("n") > 1, "several_donors").when(F.col("p0") != F.col("p1"), "conflicting_points").otherwise("matched")
    return out.withColumn("how", how).select("id", F.when(F.col("how") == "matched", F.col("g")).alias("donor"), F.when(F.col("how") == "matched", F.col("p0")).alias("point"), "how")


def standing(entities: DataFrame, asserted: DataFrame, founded: DataFrame) -> DataFrame:
    """Entities that the current release asserts or that were founded by hand. asserted, founded: (entity)."""
    return entities.join(asserted.select("entity").unionAll(founded.select("entity")).distinct(), "entity", "left_semi")


def crosswalk_candidates(control: DataFrame, facilities: DataFrame, matched: DataFrame) -> DataFrame:
    """(control_id, facility_id, head, shared): for control rows without a match the first facility of their city and state that shares the name's first word.

    control: (control_id, name, city, state); facilities: (ord, facility_id, name, city, state); matched: (control_id, facility_id).
    """
    words = lambda: F.split(norm_name(F.col("name")), " ")
    place = F.concat_ws("|", city_key(F.col("city")), F.upper("state"))
    c = control.join(matched.select("control_id").distinct(), "control_id", "left_anti").select("control_id", words().alias("cw"), place.alias("place"), words()[0].alias("head")).where((F.length("head") >= 3) & ~F.col("place").rlike(r"^\||\|$"))
    f = facilities.join(matched.select("facility_id").distinct(), "facility_id", "left_anti").select("ord", "facility_id", F.array_distinct(words()).alias("fw"), place.alias("place"))
    # What a place and word find is the same for all control rows: one facility (a facility twice under one order: each of its names).
    held = f.withColumn("head", F.explode("fw"))
    least = held.groupBy("place", "head").agg(F.min(F.struct("ord", "facility_id")).alias("x")).select("place", "head", "x.*")
    same = (held["place"] == least["place"]) & (held["head"] == least["head"]) & held["ord"].eqNullSafe(least["ord"]) & held["facility_id"].eqNullSafe(least["facility_id"])
    met = c.join(held.join(least, same, "left_semi").distinct(), ["place", "head"])
    first = met.groupBy("control_id").agg(F.min(F.struct("ord", "facility_id", "head", F.array_join(F.sort_array(F.array_intersect(F.array_distinct("cw"), "fw")), " ").alias("shared"))).alias("x"))
    return first.select("control_id", "x.facility_id", "x.head", "x.shared")


def control_status(control: DataFrame, outcome: DataFrame, holders: DataFrame) -> DataFrame:
    """(control_id, status, has_address, why) of every control row: found, or why not. outcome: (control_id, tier); holders: (control_id, source)."""
    held = holders.groupBy("control_id").agg(F.count("*").alias("k"))
    rows = control.select("control_id").join(outcome, "control_id", "left").join(held, "control_id", "left")
    have = F.col("tier").isNotNull()
    return rows.select(
        "control_id", F.when(have, "HAVE").otherwise("MISSING").alias("status"), F.when(have, F.when(F.col("tier") != "T0", "yes").otherwise("no")).otherwise("").alias("has_address"),
        F.when(have, "").when(F.col("k").isNull(), "never ingested").otherwise("ingested but lost").alias("why"),
    )


def source_gap(status: DataFrame) -> DataFrame:
    """(in_scope, found, lost, never, ceiling): what could be found without a new source."""
    found, never = F.count_if(F.col("status") == "HAVE"), F.count_if(F.col("why") == "never ingested")
    return status.agg(F.count("*").alias("in_scope"), found.alias("found"), F.count_if(F.col("why") == "ingested but lost").alias("lost"), never.alias("never"), F.round((F.count("*") - never) / F.count("*"), 4).alias("ceiling"))


# What a rejection says, and the bucket it counts in; the first that stands in it counts.
LOCATE_REASONS = [
    ("not a street address", "not a street address"), ("no citation", "no citation"), ("cited a page search did not visit", "cited a page search never opened"),
    ("below", "confidence below threshold"), ("the cited page does not contain", "page did not contain the address"), ("could not read the cited page", "page could not be read"),
]


def locate_funnel(rows: DataFrame, reason: str, call: str) -> DataFrame:
    """(bucket, rows, calls): rejections by bucket; a call that gave several rows counts once."""
    bucket = F.lit("model found nothing it could cite")
    for said, name in reversed(LOCATE_REASONS):
        bucket = F.when(F.contains(F.col(reason), F.lit(said)), name).otherwise(bucket)
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), F.count_distinct(call).alias("calls"))


def admitted_points(points: DataFrame, admitted: list[str], radius_m: float = 50.0) -> DataFrame:
    """(id, admitted, why) of computed points: of an admitted kind, with the row's ZIP, and a building within the radius. points: (id, kind, own_zip, zip, building_m)."""
    why = (
        F.when(F.col("kind").isNull(), "never geocoded").when(F.col("kind") == "rooftop", "already a rooftop coordinate").when(~F.col("kind").isin(admitted), "kind is not admitted")
        .when((zip5(F.col("own_zip")) == "") | (zip5(F.col("own_zip")) != zip5(F.col("zip"))), "the postcode it returned is not ours")
        .when(F.col("building_m").isNull() | (F.col("building_m") > radius_m), "no building within the radius").otherwise("")
    )
    return points.select("id", (why == "").alias("admitted"), why.alias("why"))


def capability_report(answers: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(grp, leaf, n, unsure, least, most): every leaf of the taxonomy with its answers, those never used with none. answers: (leaf, confidence); taxonomy: (grp, leaf)."""
    found = answers.groupBy("leaf").agg(F.count("*").alias("n"), F.count_if(F.col("confidence") < 0.5).alias("unsure"), F.min("confidence").alias("least"), F.max("confidence").alias("most"))
    return taxonomy.join(found, "leaf", "left").select("grp", "leaf", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("unsure", F.lit(0)).alias("unsure"), "least", "most")


def summed(summaries: DataFrame, by: list[str], sums: list[str], least: list[str] = (), every: list[str] = ()) -> DataFrame:
    """One summary of several: numbers add up, the least of repeats stands, flags hold if all hold."""
    return summaries.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in least], *[F.bool_and(c).alias(c) for c in every])


def net_moves(old: DataFrame, new: DataFrame, label: str) -> DataFrame:
    """(category, lost, won, net) of a label between two runs over the rows of both. old, new: (row_hash, label, category)."""
    both = old.select("row_hash", F.col("label").alias("a")).join(new.select("row_hash", F.col("label").alias("b"), "category"), "row_hash")
    was, now = F.coalesce(F.col("a") == label, F.lit(False)), F.coalesce(F.col("b") == label, F.lit(False))
    out = both.groupBy("category").agg(F.count_if(was & ~now).alias("lost"), F.count_if(~was & now).alias("won"))
    return out.withColumn("net", F.col("won") - F.col("lost"))


def cache_stats(cache: DataFrame) -> DataFrame:
    """(kind, provider, entries, positives, calls_saved) of a lookup cache."""
    return cache.groupBy("kind", "provider").agg(F.count("*").alias("entries"), F.sum("found").alias("positives"), F.sum("hits").alias("calls_saved"))


def by_rank(df: DataFrame, column: str, ranks: list[str], *then: str) -> DataFrame:
    """Rows in the order of a list of values, others last, then by further columns."""
    rank = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for i, v in enumerate(ranks) for x in (v, i)]), F.col(column)), F.lit(len(ranks)))
    return df.orderBy(rank, *then)


def work_list(items: DataFrame, done: DataFrame, leases: DataFrame, now: Column, most_tries: int = 3) -> DataFrame:
    """(item, state): what to do next. items: (item); done: (item); leases: (item, until, tries).

    An item is done, leased to someone until a time, given up after most_tries, or open.
    """
    last = leases.groupBy("item").agg(F.max("until").alias("until"), F.max("tries").alias("tries"))
    rows = items.join(done.select("item").distinct().withColumn("done", F.lit(True)), "item", "left").join(last, "item", "left")
    return rows.select("item", F.when(F.col("done"), "done").when(F.col("until") > now, "leased").when(F.col("tries") >= most_tries, "given_up").otherwise("open").alias("state"))


def taken(df: DataFrame, how: str, n: int, order: list[str], stratum: str | None = None, seed: str = "") -> DataFrame:
    """A sample by a stated rule: the first n, every nth, or n by a seeded hash, in turn over strata where there are any.

    Rows are ranked a stratum at a time; without strata, every nth counts in one order.
    """
    if how == "first":
        return df.orderBy(*order).limit(n)
    if how == "every":
        from factloom.operators.clustering import numbered

        return numbered(df, order[0], "_no").where(F.col("_no") % n == 0).drop("_no")
    lot = F.md5(F.concat_ws("|", F.lit(seed), *[F.col(c).cast("string") for c in order]))
    if stratum is None:
        return df.orderBy(lot, *order).limit(n)
    turn = F.row_number().over(Window.partitionBy(stratum).orderBy(lot, *order))
    return df.withColumn("_turn", turn).orderBy("_turn", stratum).limit(n).drop("_turn")
