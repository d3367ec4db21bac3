"""The engine's pipelines over feature layers: classification, dissolve, clusters, overlays, version diff, sampling.

Layers are DataFrames with a key ``fid`` and a bounding box; operators that cut geometry take a WKB column ``geom``
and use the geometry kernel. Every function is lazy except where components or greedy matching must iterate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terraloom.common import Scratch, name_key
from terraloom.functions.kernel import geo, with_bounds
from terraloom.functions.scalar import (
    box_ring, clamp_low, differs, effective_width, geodesic, half_even, hashed_normal, hashed_uniform, int_or_null, large_small, lonlat_to_3112,
    mercator_to_lonlat, number_or_null, pair_key, ring_wkt, safe_ratio, size_class, split_list,
)
from terraloom.operators import attributes as at
from terraloom.operators.graph import connected_components, greedy_match
from terraloom.operators.spatial import (
    box_distance, box_pairs, cell_masks, common_area, contact_components, dissolve, equal_boxes, exact, first_come, nearest, overlap_totals, pair, spatial_join,
)

#: Fixed values of the domain.
TIER1 = ("src_ahs", "src_kim", "src_unep", "src_ga")
MAPPED = (*TIER1, "src_bath_m", "src_cht_m")
INDICATED = ("src_bath_i", "src_cht_i")
OVERLAP_COUNTS, OVERLAP_REPORTS = 0.0005, 0.0001
IOU_THRESHOLD = 0.5
CLUSTER_DISTANCE_M = 100.0
COMPARED = ("attachment", "depthcat")


# Classification


def crosswalk_by_list(features: DataFrame, crosswalk: DataFrame, old: str, new: str, on: str) -> DataFrame:
    """Renames classes by a table whose ``old`` field lists several names; unmatched classes become null.

    Raises if a name stands in two rows of the table.
    """
    pairs = crosswalk.where(F.col(old).isNotNull()).select(F.explode(split_list(old)).alias("_old"), F.col(new).alias("_new"))
    at.require(at.duplicate_keys(pairs, "_old"), "class mapped twice")
    return features.join(pairs, features[on] == pairs["_old"], "left").drop("_old", on).withColumnRenamed("_new", on)


def crosswalk_by_name(features: DataFrame, pairs: DataFrame, old: str, new: str, on: str) -> DataFrame:
    """Renames classes by a table with one name in each row, compared as names compare; unmatched classes become null.

    Raises if a name stands in two rows of the table.
    """
    keyed = pairs.select(name_key(old).alias("_old"), F.col(new).alias("_new")).where(F.col("_old").isNotNull())
    at.require(at.duplicate_keys(keyed, "_old"), "class mapped twice")
    return features.join(keyed, name_key(features[on]) == keyed["_old"], "left").drop("_old", on).withColumnRenamed("_new", on)


def crosswalk_by_dict(features: DataFrame, mapping: DataFrame, on: str, fields: list[str]) -> DataFrame:
    """Attribute sets by class; a class that isn't mapped gets 'Unknown' in each field, and 'N' in ``Paleo``."""
    known = mapping.select(F.col(on), F.lit(True).alias("_known"), *fields)
    out = features.join(known, on, "left")
    other = {f: F.when(F.col("_known"), F.col(f)).otherwise(F.lit("N" if f.lower() == "paleo" else "Unknown")) for f in fields}
    return out.withColumns(other).drop("_known")


def class_crosswalk(features: DataFrame, mapping: DataFrame, on: str, fields: list[str], prefix: str = "NW_") -> DataFrame:
    """Features with a geometry, their class's attribute set and a running ``debugid`` in the order of ``fid``, from 0."""
    there = features.where(F.col("geom").isNotNull() & ~geo("is_empty", "geom"))
    numbered = at.sequential_id(crosswalk_by_dict(there, mapping, on, fields), [F.col("fid")], "_no", 0)
    return numbered.withColumn("debugid", F.concat(F.lit(prefix), F.col("_no").cast("string"))).drop("_no")


def expand_attributes(features: DataFrame, crosswalk: DataFrame, key: tuple[str, str], lists: dict[str, str], fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """(matched with fields, mismatched). Depth is filled with Shallow and accuracy made whole first."""
    prepared = at.fill_blanks(features, {"depthcat": "Shallow"}).withColumn("edgeacc_m", F.coalesce(int_or_null("edgeacc_m"), F.lit(0)))
    listed = crosswalk.withColumns({c: split_list(c) for c in lists.values()})
    joined = at.lookup_first(prepared, listed, key, lists, "row_no", fields, "fid")
    return joined.where(F.col("matched_row").isNotNull()), joined.where(F.col("matched_row").isNull()).select(*prepared.columns)


def expand_strict(features: DataFrame, crosswalk: DataFrame, key: tuple[str, str], lists: dict[str, str], fields: list[str]) -> DataFrame:
    """Features (outlines in degrees) with the fields of their crosswalk row and ``area_km2`` in the national grid.

    Raises if any feature matches no row, with the mismatches by class and attributes: one output excludes the other.
    """
    matched, mismatched = expand_attributes(features, crosswalk, key, lists, fields)
    at.require(mismatched.groupBy(key[0], *lists).agg(F.count(F.lit(1)).alias("n")), "features without a crosswalk row")
    return matched.withColumn("area_km2", half_even(geo("area", geo("to_3112", "geom")) / 1e6, 4))


# Components, dissolve, clusters


def same_class_components(layer: DataFrame, cell: float, within: float = 0.0) -> DataFrame:
    """(fid, component): features of one class linked by contact, or by a distance of at most ``within``.

    With a geometry column the outlines decide; boxes are the candidates only.
    """
    if "geom" in layer.columns:
        return contact_components(layer, cell, within, ("cls",))
    cols = ["fid", "cls", "x0", "y0", "x1", "y1"]
    touch = box_pairs(layer.select(*cols), layer.select(*cols), cell, within)
    touch = touch.where((F.col("l_cls") == F.col("r_cls")) & (F.col("l_fid") < F.col("r_fid")))
    if within > 0:
        touch = touch.where(box_distance() <= within)
    return connected_components(touch.select("l_fid", "r_fid"), "l_fid", "r_fid", layer, "fid")


def dissolve_attributes(layer: DataFrame, comps: DataFrame) -> DataFrame:
    """One row per component with the members' attributes put together."""
    fields = ("rb_type_l3", "attachment", "depthcat", "featconf", "typeconf", "edgesrc", "edgeacc_m")
    members = layer.join(comps, "fid").select("cls", "component", *[F.col(c).alias(f"_{c}") for c in fields])
    return members.groupBy("cls", "component").agg(
        at.joined_set("_rb_type_l3").alias("rb_l3_agg"),
        at.pick_attachment("_attachment").alias("attachment"),
        at.listed_set("_attachment", at.ATTACHMENT).alias("attset"),
        at.pick_depth("_depthcat").alias("depthcat"),
        at.worst_confidence("_featconf").alias("featconf"),
        at.worst_confidence("_typeconf").alias("typeconf"),
        at.joined_set("_edgesrc").alias("edgesrc"),
        at.max_whole("_edgeacc_m").alias("edgeacc_m"),
        F.count(F.lit(1)).alias("n_parts"),
    )


def dissolve_layer(layer: DataFrame, cell: float, eps: float = 1e-6) -> DataFrame:
    """One row per group of features of a class whose outlines meet or are at most ``2 * eps`` apart.

    The outline is the members' union closed by ``eps``; ``multi_attachment`` marks groups of more than one attachment.
    """
    comps = same_class_components(layer, cell, 2 * eps)
    made = dissolve_attributes(layer, comps)
    union = dissolve(layer.select("fid", "cls", geo("buffer0", "geom").alias("geom")).join(comps, "fid"), ["cls", "component"], cell * 8)
    union = union.select("cls", "component", geo("close", "geom", eps).alias("geom"))
    return made.withColumn("multi_attachment", F.col("attset").contains(";")).join(union, ["cls", "component"])


def clusters(layer: DataFrame, cell: float, distance: float = CLUSTER_DISTANCE_M, unit_m: float = 1.0) -> DataFrame:
    """Countable clusters per class: members at most ``distance`` apart, summed area, effective width, size class, united outline.

    ``distance`` and ``cell`` are in layer units of ``unit_m`` metres.
    """
    comps = same_class_components(layer, cell, distance)
    members = layer.withColumn("_area", geo("area", "geom") * unit_m**2).join(comps, "fid")
    area = members.groupBy("cls", "component").agg(F.sum("_area").alias("_a"), F.count(F.lit(1)).alias("n_parts"))
    width = effective_width(F.col("_a"))
    facts = area.select(
        "cls", "component", "n_parts", half_even(F.col("_a") / 1e6, 5).alias("c_area_km2"),
        half_even(width, 1).alias("eff_wid_m"), size_class(width).alias("size_class"),
    )
    return facts.join(dissolve(members, ["cls", "component"], cell * 8), ["cls", "component"]).withColumnRenamed("component", "cluster_id")


def largest_shift(parts: DataFrame, key: str, buffer_m: str) -> Column:
    """Of several signed values the one with the largest magnitude."""
    return F.max_by(F.col(buffer_m), F.struct(F.abs(F.col(buffer_m)), F.col(key)))


# Source matching


def source_flags(units: DataFrame, refs: DataFrame, sources: list[str], cell: float, on: Column | None = None) -> DataFrame:
    """A flag per source: the unit meets any feature of it."""
    pairs = box_pairs(units, refs, cell)
    pairs = pairs if on is None else pairs.where(on)
    seen = pairs.groupBy(F.col("l_fid").alias("fid")).agg(*[F.max(F.col("r_source") == s).alias(f"src_{s.lower()}") for s in sources])
    return units.join(seen, "fid", "left").fillna(False, [f"src_{s.lower()}" for s in sources])


def known_status(mapped: tuple[str, ...] = MAPPED, indicated: tuple[str, ...] = INDICATED) -> Column:
    any_of = lambda cs: reduce(lambda a, b: a | b, [F.col(c) for c in cs])
    return F.when(any_of(mapped), "Previously mapped").when(any_of(indicated), "Previously indicated").otherwise("Newly mapped")


def coverage(flags: DataFrame, sources: list[str]) -> DataFrame:
    """(source, n, share, n_only): units matched by each source, and those that only it matches, among ``sources``."""
    hits = reduce(lambda a, b: a + b, [F.col(s).cast("int") for s in sources])
    per = [F.struct(F.lit(s).alias("source"), F.col(s).alias("on"), (F.col(s) & (hits == 1)).alias("only")) for s in sources]
    long = flags.select(F.explode(F.array(*per)).alias("p")).select("p.*")
    out = long.groupBy("source").agg(F.count_if("on").alias("n"), F.count_if("only").alias("n_only"), F.count(F.lit(1)).alias("_t"))
    share = lambda c: half_even(safe_ratio(F.col(c).cast("double"), F.col("_t")), 4)
    return out.select("source", "n", share("n").alias("share"), "n_only", share("n_only").alias("share_only"))


def cumulative_coverage(flags: DataFrame, sources: list[str]) -> DataFrame:
    """(place, source, n_new, n_upto): union coverage with the sources in order of their own coverage."""
    own = coverage(flags, sources)
    order = own.withColumn("_i", F.array_position(F.array(*map(F.lit, sources)), F.col("source")))
    order = order.withColumn("place", F.row_number().over(Window.orderBy(F.col("n").desc(), "_i"))).select("source", "place")  # one row per source
    per = F.filter(F.array(*[F.when(F.col(s), F.lit(s)) for s in sources]), lambda x: x.isNotNull())
    first = (
        flags.select(F.col("cluster_id"), F.explode(per).alias("source")).join(order, "source").groupBy("cluster_id").agg(F.min("place").alias("place"))
    )
    new = first.groupBy("place").agg(F.count(F.lit(1)).alias("n_new"))
    w = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    out = order.join(new, "place", "left").fillna(0, ["n_new"])
    return out.select("place", "source", "n_new", F.sum("n_new").over(w).alias("n_upto"))


def missed_references(refs: DataFrame, features: DataFrame, boundary: DataFrame, cell: float) -> DataFrame:
    """What of each reference that no feature meets lies in the boundary; references outside it go. Tags come as squares already."""
    every = refs.withColumn("_k", F.concat_ws("/", "source", "fid"))
    cols = ["fid", "geom", "x0", "y0", "x1", "y1"]
    missed = spatial_join(every, features.select(*cols), cell, on=exact("intersects"), how="anti", key="_k")
    return clip(missed.drop("fid").withColumnRenamed("_k", "fid"), boundary, cell * 8)


def uncharted(features: DataFrame, region: DataFrame, area: DataFrame, cell: float, large: float) -> tuple[DataFrame, DataFrame]:
    """(per class of the region: n, n_uncharted, percent, area; per size over all features: n, area).

    Features are cut to the region; what is left of them counts as uncharted if it meets the area. ``area`` sums the
    features' own attribute, not what is left of them, and sizes are those of all features, in the region or not: Large above ``large``,
    else, null included, Small.
    """
    cols = ["fid", "geom", "x0", "y0", "x1", "y1"]
    inside = clip(features, region, cell * 8)
    hit = spatial_join(inside.select(*cols), area.select(*cols), cell, on=exact("intersects"), how="semi").select("fid", F.lit(True).alias("_u"))
    both = inside.join(hit, "fid", "left").withColumn("_u", F.coalesce("_u", F.lit(False)))
    n, u = F.count(F.lit(1)), F.count_if("_u")
    per = both.groupBy("cls").agg(n.alias("n"), u.alias("n_uncharted"), half_even(safe_ratio(u.cast("double"), n), 4).alias("pct"), F.sum("area").alias("area"))
    return per, features.groupBy(large_small(F.col("area"), large).alias("size")).agg(n.alias("n"), F.sum("area").alias("area"))


# Overlays


def overlap_report(layer: DataFrame, cell: float, least: float = OVERLAP_REPORTS) -> DataFrame:
    """Unordered pairs with an overlap of more than ``least``, contact alone not counted; with its centroid and area."""
    cols = ["fid", "cls", "geom", "plain", "x0", "y0", "x1", "y1"]
    layer = Scratch(layer.sparkSession).keep(layer.withColumn("plain", geo("plain", "geom")).select(*cols))  # read for both sides
    pairs = box_pairs(layer, layer, cell).where(F.col("l_fid") < F.col("r_fid"))
    pairs = pairs.withColumn("_o", pair("shared")).where(F.col("_o.area") > least)
    return pairs.select(
        F.col("l_fid").alias("feature_1"), F.col("r_fid").alias("feature_2"), F.col("_o.area").alias("area"), F.col("_o.x").alias("x"),
        F.col("_o.y").alias("y"), pair_key(F.col("l_cls"), F.col("r_cls")).alias("types"),
    )


def overlap_counts(layer: DataFrame, cell: float, least: float = OVERLAP_REPORTS) -> DataFrame:
    """Number and summed area of the pairs of ``overlap_report`` by their types, without a row for each pair."""
    found = overlap_totals(layer.withColumn("plain", geo("plain", "geom")).select("fid", "cls", "geom", "plain", "x0", "y0", "x1", "y1"), cell, least)
    return found.groupBy(pair_key(F.col("l_cls"), F.col("r_cls")).alias("types")).agg(F.sum("n").alias("n"), F.sum("area").alias("area"))


def priority_overlaps(targets: DataFrame, overlays: DataFrame, cell: float, least: float = OVERLAP_COUNTS) -> DataFrame:
    """Each target minus the overlays it overlaps by more than ``least``, in overlay order; emptied targets go.

    The overlays of one target are folded in order inside one call, as an earlier cut can make a later one moot.
    """
    hits = box_pairs(targets.select("fid", "geom", "x0", "y0", "x1", "y1"), overlays.select("fid", "geom", "x0", "y0", "x1", "y1"), cell)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("r_fid", "r_geom"))), lambda s: s["r_geom"])
    cut = hits.groupBy(F.col("l_fid").alias("fid")).agg(ordered.alias("_over"))
    out = targets.join(cut, "fid", "left").withColumn("_r", F.when(F.col("_over").isNotNull(), geo("subtract_in_order", "geom", "_over", least)))
    out = out.withColumns({"n_cuts": F.coalesce(F.col("_r.n"), F.lit(0)), "geom": F.coalesce(F.col("_r.geom"), F.col("geom"))})
    return out.where(~geo("is_empty", "geom")).drop("_over", "_r")


def difference(features: DataFrame, minus: DataFrame, cell: float, polygons: bool = True) -> DataFrame:
    """Each feature minus the union of the ``minus`` features it meets; emptied features go, others stay as they are."""
    hits = cell_masks(features, minus, cell).where(exact("intersects"))
    # Only what lies in the feature's own box is gathered, however large the other side's geometries are.
    cut = hits.select(F.col("l_fid").alias("fid"), geo("cut_to_box", "r_geom", "l_geom").alias("g")).groupBy("fid").agg(geo("union_all", F.collect_list("g")).alias("_cut"))
    out = features.join(cut, "fid", "left")
    left = geo("difference", "geom", "_cut")
    left = geo("polygons_only", left) if polygons else left
    out = out.withColumn("geom", F.when(F.col("_cut").isNull(), F.col("geom")).otherwise(left)).drop("_cut")
    return with_bounds(out.where(F.col("geom").isNotNull() & ~geo("is_empty", "geom")))


def clip(features: DataFrame, mask: DataFrame, cell: float) -> DataFrame:
    """What of each feature lies in the union of the mask features it meets; attributes stay, emptied features go."""
    hits = box_pairs(features.select("fid", "geom", "x0", "y0", "x1", "y1"), mask.select("fid", "geom", "x0", "y0", "x1", "y1"), cell)
    near = hits.where(exact("intersects")).select(F.col("l_fid").alias("fid"), geo("cut_to_box", "r_geom", "l_geom").alias("g"))
    keep = near.groupBy("fid").agg(geo("union_all", F.collect_list("g")).alias("_keep"))
    out = features.join(keep, "fid").withColumn("geom", geo("intersection", "geom", "_keep")).drop("_keep")
    return with_bounds(out.where(~geo("is_empty", "geom")))


def feature_mask(reefs: DataFrame, coast: DataFrame, regions: DataFrame, land: DataFrame, cell: float, reach: float = 0.05, tolerance: float = 0.001) -> DataFrame:
    """Search area around reefs and the regions' coast, less land: buffered, simplified parts rather than one geometry."""
    near = reefs.select("geom", "x0", "y0", "x1", "y1").unionByName(clip(coast, regions, cell).select("geom", "x0", "y0", "x1", "y1"))
    grown = with_bounds(near.select(geo("buffer", geo("simplify", "geom", tolerance), reach).alias("geom"))).withColumn("fid", F.xxhash64("geom"))
    wet = difference(grown.dropDuplicates(["fid"]), land, cell)
    return with_bounds(wet.select("fid", geo("simplify", "geom", tolerance).alias("geom")))


def single_parts(layer: DataFrame) -> DataFrame:
    """One row per part, with the part's own box."""
    return with_bounds(layer.withColumn("geom", F.explode(geo("parts", "geom"))))


def split_by_type(layer: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(polygonal features, all others and null geometries)."""
    polygonal = F.coalesce(geo("type", "geom").isin("Polygon", "MultiPolygon"), F.lit(False))
    return layer.where(polygonal), layer.where(~polygonal)


def geometry_violations(layer: DataFrame) -> DataFrame:
    """(fid, reason) of null, empty, invalid and non-polygonal geometries."""
    why = (
        F.when(F.col("geom").isNull(), "null").when(geo("is_empty", "geom"), "empty")
        .when(~geo("type", "geom").isin("Polygon", "MultiPolygon"), "not polygonal").when(~geo("is_valid", "geom"), geo("invalid_reason", "geom"))
    )
    return layer.select("fid", why.alias("reason")).where(F.col("reason").isNotNull())


def clip_land(features: DataFrame, land: DataFrame, cell: float, strict: bool = True) -> DataFrame:
    """Features without land. ``strict`` raises on bad geometry; otherwise it is repaired first."""
    if strict:
        at.require(geometry_violations(features), "features")
        at.require(geometry_violations(land), "land")
    else:
        features = with_bounds(features.withColumn("geom", geo("make_valid", "geom")))
        land = with_bounds(land.withColumn("geom", geo("make_valid", "geom")))
    return difference(features, land, cell, polygons=False)


def clip_land_split(features: DataFrame, land: DataFrame, cell: float) -> tuple[DataFrame, DataFrame]:
    """(polygonal features without land, rejected features): others than polygons and null geometries don't stop the clip, bad polygons do."""
    polygons, rejected = split_by_type(features)
    return clip_land(polygons, land, cell), rejected


def correct_mask(mask: DataFrame, corrections: DataFrame, cell: float) -> DataFrame:
    """(mask with additions) minus removals, as valid single parts that are not joined across grid cells more than needed.

    All parts take the attributes of the mask's first feature (smallest fid).
    """
    box = ("fid", "geom", "x0", "y0", "x1", "y1")
    template = mask.orderBy("fid").limit(1).select([c for c in mask.columns if c not in box])
    polygonal = lambda df: df.where(geo("is_valid", "geom") & geo("type", "geom").isin("Polygon", "MultiPolygon"))
    add = corrections.where(F.col("operation") == "Add").select("geom", "x0", "y0", "x1", "y1")
    base = polygonal(mask.select("geom", "x0", "y0", "x1", "y1").unionByName(add))
    keep = Scratch(mask.sparkSession).keep  # each is read several times
    base = keep(base.withColumn("fid", F.xxhash64("geom")).dropDuplicates(["fid"]))
    comps = contact_components(base, cell)
    joined = dissolve(base.join(comps, "fid"), ["component"], cell * 8).withColumnRenamed("component", "fid")
    remove = polygonal(corrections.where(F.col("operation") == "Remove").select("geom", "x0", "y0", "x1", "y1")).withColumn("fid", F.xxhash64("geom"))
    parts = single_parts(difference(keep(with_bounds(joined)), remove, cell)).where(geo("is_valid", "geom"))
    return parts.join(template, how="left") if template.columns else parts


def residual_features(mask: DataFrame, features: DataFrame, constants: dict[str, str], cell: float) -> DataFrame:
    """What of the mask no feature covers, as single parts with constant attributes."""
    rest = single_parts(difference(mask.where(geo("is_valid", "geom")), features, cell))
    return rest.withColumns({k: F.lit(v) for k, v in constants.items()})


def connected_merge(masters: DataFrame, others: DataFrame, cell: float, on: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(merged masters, untouched others).

    Others that meet a master are absorbed; masters count as linked only through an other that meets both. Each
    group becomes its first master (smallest fid) with ``members`` and ``absorbed`` ids, and the union if both have geometry.
    """
    hits = box_pairs(others, masters, cell)
    hits = hits if on is None else hits.where(on)
    links = hits.select(F.col("l_fid").alias("o"), F.col("r_fid").alias("m"))
    first = links.groupBy("o").agg(F.min("m").alias("f"))
    comps = connected_components(links.join(first, "o"), "m", "f", masters, "fid")
    swallowed = links.join(comps, links.m == comps.fid).select("component", "o").distinct()
    ids = swallowed.groupBy("component").agg(F.sort_array(F.collect_list("o")).alias("absorbed"))
    members = comps.groupBy("component").agg(F.sort_array(F.collect_list("fid")).alias("members"))
    out = masters.join(members.join(ids, "component", "left"), F.col("fid") == F.col("component")).drop("component")
    if "geom" in masters.columns and "geom" in others.columns:
        parts = masters.join(comps, "fid").select("component", "geom").unionByName(
            swallowed.join(others, swallowed.o == others.fid).select("component", "geom")
        )
        union = parts.groupBy(F.col("component").alias("fid")).agg(geo("union_all", F.collect_list("geom")).alias("geom"))
        out = with_bounds(out.drop("geom").join(union, "fid"))
    return out, others.join(links.select(F.col("o").alias("fid")).distinct(), "fid", "left_anti")


def mask_confusion(rough: DataFrame, auto: DataFrame, land: DataFrame, cell: float) -> DataFrame:
    """(metric, value): detections of one mask against the other, away from land and from coastal features. Outlines decide."""
    meet, cols = exact("intersects"), ["geom", "x0", "y0", "x1", "y1"]
    coastal = spatial_join(rough, land, cell, on=meet, how="semi")
    platform = spatial_join(rough, land, cell, on=meet, how="anti")
    zone = land.select(*cols).unionByName(coastal.select(*cols)).withColumn("fid", F.lit(0))
    own = spatial_join(auto, zone, cell, on=meet, how="anti")
    hit = box_pairs(own.select("fid", *cols), platform.select("fid", *cols), cell).where(meet)
    pairs = hit.select(F.col("l_fid").alias("a"), F.col("r_fid").alias("r"))
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    one = (
        count(platform, "rough").withColumn("_j", F.lit(1))
        .join(count(own, "auto").withColumn("_j", F.lit(1)), "_j")
        .join(pairs.agg(F.count_distinct("a").alias("tp"), F.count_distinct("r").alias("tp_rough")).withColumn("_j", F.lit(1)), "_j")
    )
    n = F.col
    rate = lambda a, b: half_even(safe_ratio(a.cast("double"), b), 4)
    facts = {
        "rough_platform": n("rough"), "auto_platform": n("auto"), "true_positives": n("tp"), "true_positives_rough": n("tp_rough"),
        "false_positives": n("auto") - n("tp"), "false_negatives": n("rough") - n("tp_rough"),
        "true_positive_rate": rate(n("tp"), n("rough")), "false_positive_rate": rate(n("auto") - n("tp"), n("auto")),
        "false_negative_rate": rate(n("rough") - n("tp_rough"), n("rough")), "true_positive_rate_rough": rate(n("tp_rough"), n("rough")),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in facts.items()])
    return one.select(F.explode(rows).alias("r")).select("r.*")


# Version diff


def version_diff(old: DataFrame, new: DataFrame, cell: float, iou_least: float = IOU_THRESHOLD, compared: tuple[str, ...] = COMPARED) -> DataFrame:
    """(change, new_fid, old_fid, attr_chg): exact matches, then greedy matches by overlap, then the pools that remain.

    Outlines are equal if their vertices are, in order and within 1e-9; the overlap is that of the outlines.
    """
    keep = Scratch(new.sparkSession).keep  # each is read several times
    slim = lambda df: keep(df.select("fid", "geom", "x0", "y0", "x1", "y1").withColumns({"plain": geo("plain", "geom"), "a": geo("area", "geom")}))
    left = lambda df, done, fid: df.join(done.select(F.col(fid).alias("fid")), "fid", "left_anti")
    ids = [F.col("l_fid").alias("new_fid"), F.col("r_fid").alias("old_fid")]
    new_s, old_s = slim(new), slim(old)
    same = equal_boxes(new_s, old_s, 1e-9).where(geo("equals_exact", "l_geom", "r_geom", 1e-9) & exact("intersects")).select(*ids)
    eq = keep(first_come(same, "new_fid", "old_fid", [F.col("new_fid"), F.col("old_fid")]))
    # Only what has no equal is compared by overlap, and only where the boxes leave room for enough of it.
    new_s, old_s = keep(left(new_s, eq, "new_fid")), keep(left(old_s, eq, "old_fid"))
    total, box = F.col("l_a") + F.col("r_a"), common_area()
    room = F.least("l_a", "r_a", box) * (1 + 1e-9) * (1 + iou_least) >= total * iou_least
    scored = box_pairs(new_s, old_s, cell).where(room).withColumn("_c", pair("shared_area")).withColumn("_sum", total)
    scored = scored if iou_least > 0 else scored.where(pair("relation") > 0)
    iou = F.when(F.col("_sum") > F.col("_c"), F.round(F.col("_c") / (F.col("_sum") - F.col("_c")), 12)).otherwise(0.0)
    scored = scored.select(*ids, iou.alias("iou")).where(F.col("iou") >= iou_least)
    better = keep(greedy_match(scored, "new_fid", "old_fid", "iou").select("new_fid", "old_fid"))
    pairs = eq.withColumn("change", F.lit("unchanged")).unionByName(better.withColumn("change", F.lit("improved")))
    o = old.select(F.col("fid").alias("old_fid"), *[F.col(c).alias(f"_o_{c}") for c in compared])
    n = new.select(F.col("fid").alias("new_fid"), *[F.col(c).alias(f"_n_{c}") for c in compared])
    flag = differs([(F.col(f"_o_{c}"), F.col(f"_n_{c}")) for c in compared])
    flagged = pairs.join(o, "old_fid").join(n, "new_fid").select("change", "new_fid", "old_fid", flag.alias("attr_chg"))
    rest_new = new.select(F.col("fid").alias("new_fid")).join(pairs.select("new_fid"), "new_fid", "left_anti")
    rest_old = old.select(F.col("fid").alias("old_fid")).join(pairs.select("old_fid"), "old_fid", "left_anti")
    met = keep(box_pairs(left(new_s, better, "new_fid"), left(old_s, better, "old_fid"), cell).where(pair("relation") > 0).select(*ids))
    seen_new, seen_old = met.select("new_fid").distinct(), met.select("old_fid").distinct()
    null = F.lit(None)
    wide = lambda df, change: df.select(
        F.lit(change).alias("change"), (F.col("new_fid") if "new_fid" in df.columns else null.cast("bigint")).alias("new_fid"),
        (F.col("old_fid") if "old_fid" in df.columns else null.cast("bigint")).alias("old_fid"), null.cast("boolean").alias("attr_chg"),
    )
    return (
        flagged.unionByName(wide(seen_new, "improved"))
        .unionByName(wide(rest_new.join(seen_new, "new_fid", "left_anti"), "new"))
        .unionByName(wide(rest_old.join(seen_old, "old_fid", "left_anti"), "deleted"))
    )


# Validation and boundary error


def error_statistics(err: DataFrame, region: str, error: str, matched: str) -> DataFrame:
    """Per region: counts, mean, sample deviation, median, 90th and 95th percentile and maximum of the matched errors."""
    e = F.when(F.col(matched), F.col(error))
    return err.where(F.col(region).isNotNull()).groupBy(region).agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(matched).alias("n_matched"), F.count_if(~F.col(matched)).alias("n_unmatched"),
        half_even(F.avg(e), 4).alias("mean_m"), half_even(F.stddev_samp(e), 4).alias("std_m"), F.percentile(e, 0.5).alias("median_m"),
        F.percentile(e, 0.9).alias("p90_m"), F.percentile(e, 0.95).alias("p95_m"), F.max(e).alias("max_m"),
    )


def cumulative_distribution(err: DataFrame, by: list[str], value: str, low: float = 2.5) -> DataFrame:
    """(by, value, n, percent): share of all rows up to each clamped value; rows without a value count in the total only.

    Running sums go over slices of the value axis first and within a slice then, so no task orders a whole group.
    """
    v = clamp_low(F.col(value), low)
    per = err.groupBy(*by, v.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = per.groupBy(*by).agg(F.sum("n").alias("_total"))
    per = per.where(F.col("value").isNotNull()).withColumn("_slice", F.floor(F.log2(F.greatest("value", F.lit(1e-9))) * 256))
    slices = per.groupBy(*by, "_slice").agg(F.sum("n").alias("_m"))
    before = F.sum("_m").over(Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = slices.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_m")
    inside = F.sum("n").over(Window.partitionBy(*by, "_slice").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    out = per.withColumn("_u", inside).join(slices, [*by, "_slice"]).join(total, by)
    return out.select(*by, "value", "n", half_even((F.col("_before") + F.col("_u")) / F.col("_total") * 100, 6).alias("percent"))


def loglog_fit(err: DataFrame, x: str, y: str) -> DataFrame:
    """Power law fitted in log space, its R2, and the share of rows where y exceeds x; null below two distinct values."""
    ok = err.where((F.col(x) > 0) & (F.col(y) > 0) & (F.col(x) < float("inf")) & (F.col(y) < float("inf")))
    lx, ly = F.log10(F.col(x)), F.log10(F.col(y))
    return ok.agg(
        F.count(F.lit(1)).alias("n"), half_even(F.regr_slope(ly, lx), 6).alias("slope"), half_even(F.regr_intercept(ly, lx), 6).alias("intercept"),
        half_even(F.regr_r2(ly, lx), 6).alias("r2"), half_even(F.avg((F.col(y) > F.col(x)).cast("double")) * 100, 6).alias("pct_exceeds"),
    )


def lognormal_fit(df: DataFrame, ratio: str, low: float = 0.05, high: float = 5.0) -> DataFrame:
    """Mean and population deviation of the logarithms of ratios within [low, high]; null below two values."""
    ln = F.log(F.col(ratio))
    out = df.where(F.col(ratio).between(low, high)).agg(F.count(F.lit(1)).alias("n"), F.avg(ln).alias("mu"), F.stddev_pop(ln).alias("sigma"))
    enough = lambda c: F.when(F.col("n") >= 2, half_even(F.col(c), 6))
    return out.select("n", enough("mu").alias("mu"), enough("sigma").alias("sigma"))


def edge_metrics(lines: DataFrame, fid: str, dist: str, edge: str, steps: int = 20) -> DataFrame:
    """Per reef: percentiles, rank of its stated accuracy among the distances, ratios of percentiles to the accuracy."""
    made = lines.where(F.col(dist).isNotNull()).groupBy(fid).agg(
        F.count(F.lit(1)).alias("n_samples"), F.max(edge).alias("edge"), at.percentile_vector(F.col(dist), steps).alias("_p"),
        at.percentile_rank(F.col(edge), F.col(dist)).alias("_r"),
    )
    rank = F.when(F.col("edge").isNotNull(), half_even(F.col("_r"), 1))
    rounded = F.transform("_p", lambda p: half_even(p, 1))
    ratios = F.when(F.col("edge") > 0, F.transform(rounded, lambda p: half_even(p / F.col("edge"), 4)))
    return made.select(fid, "n_samples", "edge", rank.alias("edge_perc"), rounded.alias("percentiles"), ratios.alias("ratios"))


def boundary_error(points: DataFrame, polygons: DataFrame, radius: float, regions: DataFrame | None = None, position=lambda x, y: (x, y)) -> DataFrame:
    """Nearest polygon within ``radius`` of each point (0 when inside), then the nearest point of that polygon's outline.

    ``points``: fid, x, y. ``polygons``: fid, geom, box, edgeacc_m. ``position`` gives degrees for layer coordinates.
    Unmatched points stay; of polygons equally near, to twelve decimals, the smallest fid is taken. A point on the border of two regions is in both.
    """
    spot = geo("from_text", F.concat(F.lit("POINT ("), F.col("x").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit(")")))
    pts = points.select("fid", "x", "y", spot.alias("geom")).withColumns({"x0": F.col("x"), "x1": F.col("x"), "y0": F.col("y"), "y1": F.col("y")})
    near = nearest(pts, polygons.select("fid", "geom", "x0", "y0", "x1", "y1"), radius, F.round(geo("distance", "l_geom", "r_geom"), 12), "fid", "fid")
    shape = polygons.select(F.col("fid").alias("match_fid"), geo("boundary", "geom").alias("_line"), number_or_null("edgeacc_m").alias("edgeacc_m"))
    out = pts.join(near, "fid").join(shape, "match_fid", "left").withColumn("_s", geo("nearest_on", "geom", "_line"))
    (lon, lat), (mlon, mlat) = position(F.col("x"), F.col("y")), position(geo("x0", "_s"), geo("y0", "_s"))
    out = out.select("fid", "geom", "x", "y", lat.alias("act_lat"), lon.alias("act_lon"), mlat.alias("match_lat"), mlon.alias("match_lon"), "edgeacc_m", F.col("matched").alias("match_found"), "match_fid")
    out = out.withColumn("error_m", geodesic("act_lat", "act_lon", "match_lat", "match_lon"))
    if regions is None:
        return out.drop("x", "y", "geom")
    boxed = out.withColumns({"x0": F.col("x"), "x1": F.col("x"), "y0": F.col("y"), "y1": F.col("y")})
    named = spatial_join(boxed, regions, radius * 100, on=exact("intersects"), how="left")
    return named.select(*[F.col(f"l_{c}").alias(c) for c in out.columns if c not in ("x", "y", "geom")], F.col("r_regionname").alias("regionname"))


def ring_samples(layer: DataFrame, most: int = 100) -> DataFrame:
    """(fid, part, sid, geom): points at i/k of each part's outline, k the number of its vertices up to ``most``; simple outlines (up to 4) give none.

    An outline starts at its least vertex and runs clockwise, whatever made it.
    """
    parts = layer.select("fid", F.posexplode(geo("parts", geo("normalize", "geom"))).alias("part", "_g"))
    ring = parts.withColumn("_ring", geo("exterior", "_g")).withColumn("_n", geo("unique_vertices", "_ring"))
    ring = ring.where((F.col("_n") > 4) & (geo("length", "_ring") > 0))
    ring = ring.withColumn("_k", F.least("_n", F.lit(most))).withColumn("sid", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
    spot = geo("point_along", "_ring", geo("length", "_ring") * F.col("sid") / F.col("_k"))
    return ring.select("fid", "part", "sid", spot.alias("geom"))


def nearest_lines(samples: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """Nearest linework within ``radius`` of each sample: (fid, part, sid, dist_m, geom on the line, matched)."""
    pts = with_bounds(samples.withColumn("_id", F.struct("fid", "part", "sid"))).select("_id", "geom", "x0", "y0", "x1", "y1")
    pairs = box_pairs(pts, lines.select("fid", "geom", "x0", "y0", "x1", "y1"), radius, within=radius).withColumn("d", geo("distance", "l_geom", "r_geom"))
    near = pairs.where(F.col("d") <= radius).withColumn("spot", geo("nearest_on", "l_geom", "r_geom"))
    best = near.groupBy(F.col("l__id").alias("_id")).agg(F.min("d").alias("d"), F.min_by("spot", F.struct("d", "r_fid")).alias("spot"))
    out = pts.select("_id").join(best, "_id", "left")
    return out.select("_id.fid", "_id.part", "_id.sid", half_even(F.col("d"), 1).alias("dist_m"), F.col("spot").alias("geom"), F.col("d").isNotNull().alias("matched"))


def edge_sampling(
    a: DataFrame, b: DataFrame, land: DataFrame, region: DataFrame, cell: float, radius: float = 2000.0, land_gap: float = 10.0, is_reef: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched) samples of the outlines of ``a`` with the nearest outline of ``b``.

    Reefs of the region only; ``b`` loses what is land; features without a partner on the other side go; ``a`` is
    dissolved; samples within ``land_gap`` of land go. ``radius``, ``land_gap`` and ``cell`` are in layer units.
    """
    meet, cols = exact("intersects"), ["fid", "geom", "x0", "y0", "x1", "y1"]
    here = lambda df: spatial_join(df, region, cell * 8, on=meet, how="semi")
    keep = Scratch(a.sparkSession).keep  # each is read several times
    a = keep(here(a if is_reef is None else a.where(is_reef)).select(*cols))
    b = keep(difference(here(b).select(*cols), land.select(*cols), cell))
    one, other = keep(spatial_join(a, b, cell, on=meet, how="semi")), spatial_join(b, a, cell, on=meet, how="semi")
    merged = dissolve(one.join(same_class_components(one.withColumn("cls", F.lit("")), cell), "fid"), ["component"], cell * 8)
    samples = keep(with_bounds(ring_samples(merged.withColumnRenamed("component", "fid")))).withColumn("_k", F.struct("fid", "part", "sid"))
    wet = spatial_join(samples, land.select(*cols), max(cell, land_gap), on=geo("is_near", "l_geom", "r_geom", float(land_gap)), how="anti", key="_k", within=land_gap)
    near = keep(nearest_lines(wet.select("fid", "part", "sid", "geom"), other.withColumn("geom", geo("boundary", "geom")), radius))
    return near.where("matched"), near.where("NOT matched")


def dithered(layer: DataFrame, mu: float = -0.57, sigma: float = 0.852, low: float = 0.05, high: float = 2.0, seed: int = 42, tries: int = 64) -> DataFrame:
    """Signed log-normal shift of each outline: ``buffer_m`` = +-accuracy * ratio, the ratio drawn until within [low, high]."""
    draws = F.array(*[F.exp(mu + sigma * hashed_normal(seed + i, "fid")) for i in range(tries)])
    missed = F.raise_error(F.lit(f"no ratio within [{low}, {high}] in {tries} draws")).cast("double")
    ratio = F.coalesce(F.get(F.filter(draws, lambda r: (r >= low) & (r <= high)), F.lit(0)), missed)
    sign = F.when(hashed_uniform(seed - 1, "fid") < 0.5, -1.0).otherwise(1.0)
    return layer.withColumn("ratio", ratio).withColumn("buffer_m", sign * F.col("ratio") * F.col("edgeacc_m"))


def dithered_dissolve(layer: DataFrame, cell: float, **draw) -> DataFrame:
    """(fid, buffer_m, n_parts, classes, area, geom): outlines moved as ``dithered`` says, emptied ones gone, parts that meet united.

    A group has the signed shift of the largest magnitude among its parts and the distinct classes.
    """
    moved = dithered(layer, **draw).withColumn("geom", geo("buffer", "geom", F.col("buffer_m")))
    parts = single_parts(moved.where(~geo("is_empty", "geom"))).select("cls", "buffer_m", "geom", "x0", "y0", "x1", "y1", F.xxhash64("fid", "geom").alias("fid"))
    keep = Scratch(layer.sparkSession).keep  # each is read twice
    parts = keep(parts)
    group = parts.withColumnRenamed("cls", "_cls").withColumn("cls", F.lit(""))
    member = keep(parts.join(same_class_components(group, cell), "fid"))
    facts = member.groupBy("component").agg(largest_shift(member, "fid", "buffer_m").alias("buffer_m"), F.count(F.lit(1)).alias("n_parts"), at.joined_set("cls").alias("classes"))
    out = facts.join(dissolve(member, ["component"], cell * 8), "component").withColumnRenamed("component", "fid")
    return out.withColumn("area", geo("area", "geom"))


def combine_batches(batches: DataFrame, batch: str, valid_id: str, size: int = 171) -> DataFrame:
    """ValidID made unique over batches by their position."""
    return batches.withColumn("valid_id", F.col(valid_id) + F.col(batch) * size)


def stratified_batches(features: DataFrame, region: str, fid: str, per_batch: int, seed: int) -> DataFrame:
    """(region, fid, batch): up to ``per_batch`` features per region and batch, none used twice.

    The order within a region is a hash of the id, ranked within hash slices first so that no task ranks a whole
    region: a slice's rows are numbered from the count of the slices before it.
    """
    u = hashed_uniform(seed, fid)
    f = features.select(region, fid, u.alias("_u"), F.floor(u * 256).cast("int").alias("_slice"))
    sizes = f.groupBy(region, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(region).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sizes.withColumn("_base", before).select(region, "_slice", "_base")
    rank = F.row_number().over(Window.partitionBy(region, "_slice").orderBy("_u", fid))
    return f.join(base, [region, "_slice"]).select(region, fid, F.floor((F.col("_base") + rank - 1) / per_batch).cast("int").alias("batch"))


def decoys(n: int, mask: DataFrame, box: tuple[float, float, float, float], seed: int, cell: float = 0.5, tries: int = 8, rounds: int = 24) -> DataFrame:
    """(no, x, y, width_m, aspect): n rectangles with their centres at random places within the outlines of ``mask``, sizes skewed to small.

    Places are drawn for all that have none yet, ``tries`` at first and twice as many each round up to 1,024 times that, until none is left. Raises if the mask holds so little
    of the box that ``rounds`` rounds don't do.
    """
    x0, y0, x1, y1 = box
    spark = mask.sparkSession
    scratch = Scratch(spark)
    left, found = spark.range(n).select(F.col("id").alias("no")), []
    done = 0
    for k in range(rounds):
        upto = done + tries * 2 ** min(k, 10)
        draw, done = left.select("no", F.explode(F.sequence(F.lit(done), F.lit(upto - 1))).alias("t")), upto
        draw = draw.withColumns({"x": x0 + (x1 - x0) * hashed_uniform(seed, "no", "t"), "y": y0 + (y1 - y0) * hashed_uniform(seed + 1, "no", "t")})
        text = F.concat(F.lit("POINT ("), F.col("x").cast("string"), F.lit(" "), F.col("y").cast("string"), F.lit(")"))
        draw = draw.withColumns({"fid": F.struct("no", "t"), "geom": geo("from_text", text), "x0": F.col("x"), "x1": F.col("x"), "y0": F.col("y"), "y1": F.col("y")})
        wet = spatial_join(draw, mask.select("fid", "geom", "x0", "y0", "x1", "y1"), cell, on=geo("contains", "r_geom", "l_geom"), how="semi")
        spot = scratch.keep(wet.groupBy("no").agg(F.min(F.struct("t", "x", "y")).alias("s")).select("no", "s.x", "s.y"))
        found.append(spot)
        left = scratch.keep(left.join(spot, "no", "left_anti"))
        if left.isEmpty():
            break
    else:
        raise ValueError(f"{left.count()} of {n} decoys have no place in the mask after {done} draws each")
    spot = reduce(DataFrame.unionByName, found)
    width = 50.0 + 1950.0 * F.pow(hashed_uniform(seed + 2, "no"), 2)
    aspect = 0.5 + 1.5 * hashed_uniform(seed + 3, "no")
    out = spot.select("no", "x", "y", width.alias("width_m"), aspect.alias("aspect"))
    jig = lambda k, size: (hashed_uniform(seed + k, "no") - 0.5) * 0.6 * size / 111000
    return out.withColumns({"x": F.col("x") + jig(4, F.col("width_m")), "y": F.col("y") + jig(5, F.col("width_m") / F.col("aspect"))})


def decoy_count(n_real: int, share: float = 0.3) -> int:
    return int(round(share * n_real / (1 - share)))


def fuzzed_extent(geom: str, key: str, tolerance: float, fuzz: float, seed: int) -> Column:
    """Box struct<x0, y0, x1, y1> around the simplified geometry with each vertex moved by up to ``fuzz`` in x and y."""
    flat = geo("coords", geo("simplify", geom, tolerance))
    jig = lambda v, i: v + (hashed_uniform(seed, key, i) * 2 - 1) * fuzz
    axis = lambda odd: F.transform(F.filter(F.transform(flat, lambda v, i: F.struct(jig(v, i).alias("v"), i.alias("i"))), lambda s: s["i"] % 2 == odd), lambda s: s["v"])
    x, y = axis(0), axis(1)
    return F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def boundary_points(layer: DataFrame, land: DataFrame, cell: float, key: str, tries: int = 10, seed: int = 1) -> DataFrame:
    """(key, geom): a random place on each outline that is not on land; the first of up to ``tries`` draws, else none."""
    line = layer.select(key, geo("boundary", "geom").alias("_l")).withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    spot = geo("point_along", "_l", geo("length", "_l") * hashed_uniform(seed, key, "t"))
    draws = with_bounds(line.select(F.struct(key, "t").alias("fid"), spot.alias("geom")))
    wet = spatial_join(draws, land.select("fid", "geom", "x0", "y0", "x1", "y1"), cell, on=geo("contains", "r_geom", "l_geom"), how="anti")
    first = wet.groupBy(F.col(f"fid.{key}").alias(key)).agg(F.min_by("geom", "fid.t").alias("geom"))
    return first


def in_regions(features: DataFrame, regions: DataFrame, cell: float) -> DataFrame:
    """Features with the ``regionid`` of the region that holds their centroid; those in none are left out."""
    centres = with_bounds(features.select("fid", geo("centroid", "geom").alias("geom")))
    met = spatial_join(centres, regions.select("regionid", "geom", "x0", "y0", "x1", "y1"), cell, on=geo("within", "l_geom", "r_geom"))
    return features.join(met.groupBy(F.col("l_fid").alias("fid")).agg(F.min("r_regionid").alias("regionid")), "fid")


def validation_batch(
    features: DataFrame, regions: DataFrame, land: DataFrame, batch: int, per_region: int, mask: DataFrame, box: tuple[float, float, float, float], cell: float,
    seed: int = 1, share: float = 0.3, tolerance_m: float = 50.0, fuzz_m: float = 50.0,
) -> DataFrame:
    """One batch for reviewers: (valid_id, fake, centroid, extent, boundary) of sampled features and of decoys, shuffled.

    ``features``: fid, geom in degrees. A feature is in the region that holds its centroid, the smallest ``regionid`` if several do; one in
    no region is not drawn. Decoys lie within the outlines of ``mask``. A feature without a wet boundary point keeps a null one.
    """
    features = Scratch(features.sparkSession).keep(in_regions(features, regions, cell * 8))
    chosen = stratified_batches(features, "regionid", "fid", per_region, seed).where(F.col("batch") == batch)
    real = features.join(chosen.select("fid"), "fid", "left_semi").select(F.concat(F.lit("r"), F.col("fid").cast("string")).alias("key"), "geom")
    fake = decoys(decoy_count(real.count(), share), mask, box, seed + batch, cell * 8)
    w, h = F.col("width_m") / 222000, F.col("width_m") / F.col("aspect") / 222000
    ring = ring_wkt(box_ring(F.col("x") - w, F.col("y") - h, F.col("x") + w, F.col("y") + h))
    fake = fake.select(F.concat(F.lit("f"), F.col("no").cast("string")).alias("key"), geo("from_text", ring).alias("geom"))
    every = Scratch(features.sparkSession).keep(real.withColumn("fake", F.lit(False)).unionByName(fake.withColumn("fake", F.lit(True))))
    every = at.sequential_id(every.withColumn("_u", hashed_uniform(seed + 9, "key")), [F.col("_u"), F.col("key")], "valid_id")
    spots = boundary_points(every, land, cell, "key", seed=seed).withColumnRenamed("geom", "boundary")
    deg = 1 / 111000
    extent = fuzzed_extent("geom", "key", tolerance_m * deg, fuzz_m * deg, seed)
    out = every.select("key", "valid_id", "fake", geo("inside_point", "geom").alias("centroid"), extent.alias("extent"))
    return out.join(spots, "key", "left").drop("key")


# Catalogues


def choose_tiles(tiles: DataFrame, region: str | None = None, explicit: list[str] | None = None, custom: DataFrame | None = None) -> DataFrame:
    """Explicit tiles (each must be in the region's set), else the region's, else a custom table's TileID; 'all' keeps repeats."""
    inside = tiles if region in (None, "all") else tiles.where(F.col("region") == region)
    if explicit:
        asked = tiles.sparkSession.createDataFrame([(t,) for t in explicit], "tile_id string")
        at.require(asked.join(inside, "tile_id", "left_anti"), "tiles outside the region")
        return asked
    if region:
        return inside.select("tile_id")
    if custom is not None:
        return custom.select(F.col("TileID").alias("tile_id"))
    raise ValueError("no tiles, region or custom table given")


def raster_catalogue(paths: DataFrame, base_depth: int = 0, most_depth: int = 3, least: int = 2) -> DataFrame:
    """(folder, n, mosaic, tiles): folders 1 to 3 levels below the base with at least two .tif files, the mosaic each becomes, and its tiles in order."""
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    depth = F.size(parts) - 1 - base_depth
    tifs = paths.where(F.lower("path").endswith(".tif")).select(folder.alias("folder"), depth.alias("depth"), F.element_at(parts, -1).alias("tile"))
    per = tifs.where(F.col("depth").between(1, most_depth)).groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("tile")).alias("tiles"))
    mosaic = F.concat(F.col("folder"), F.lit("/"), F.substring_index("folder", "/", -1), F.lit(".vrt"))
    return per.where(F.col("n") >= least).select("folder", "n", mosaic.alias("mosaic"), "tiles")


def project_rings(layer: DataFrame, ring: str, to: str) -> DataFrame:
    """Vertex by vertex: ``to`` is 3112 (from degrees) or 4326 (from web mercator)."""
    change = {"3112": lonlat_to_3112, "4326": mercator_to_lonlat}[to]

    def vertex(p: Column) -> Column:
        x, y = change(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return layer.withColumn(ring, F.transform(F.col(ring), vertex))
