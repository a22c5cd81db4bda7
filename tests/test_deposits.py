import json
import math
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from oreweave.functions.commodity import commodity_codes, commodity_color, commodity_names, fused_names
from oreweave.functions.text import clean_report_text, clean_scalar, coerce_double, extract_age, extract_lithology, join_distinct, report_record_id, site_key
from oreweave.functions.udfs import chunk_text, name_similarity, pack_sentences, point
from oreweave.functions.wkb import point_wkb, polygon_wkb
from oreweave.operators import analytics
from oreweave.operators.enrich import spatial_join
from oreweave.operators.fusion import assign_one_to_one, build_unified, dedupe, match_counts, name_candidates
from oreweave.operators.registry import UNIFIED, assert_valid, dropped_counts, empty_unified, enforce_schema, normalize_registry, prepare_report_records, split_valid, valid_registry
from oreweave.operators.reports import confidence, explode_mentions, merge_mentions


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(fn(F.col("v"))).first()[0]


def test_scalars(spark):
    assert [one(spark, v, clean_scalar) for v in ("a ", '" "', "N/A", "-999", '"x"', " \t", None)] == ["a", None, None, None, "x", None, None]
    assert [one(spark, v, site_key) for v in ("O'Brien No. 5", None, "Шахта")] == ["obrienno5", "", ""]
    assert one(spark, "miner-\n  al  depo\tsit", clean_report_text) == "mineral depo sit"
    assert [one(spark, v, coerce_double) for v in (" 12 ", "1.5d", "abc", "", "-9.9E-2")] == [12.0, None, None, None, -0.099]
    assert one(spark, "reports/a.pdf", lambda c: report_record_id(F.lit("Creede District"), c)) == "pdf-061b9716a90ee97a"
    assert one(spark, "a", lambda c: join_distinct(c, F.lit(" "), F.lit("b"), c)) == "a;b"
    assert one(spark, "Basaltic tuff and SHALE", lambda c: extract_lithology(c, F.lit(None).cast("string"))) == "shale"
    assert one(spark, "Odd Beds ", lambda c: extract_lithology(c, F.lit(None).cast("string"))) == "odd beds"
    assert one(spark, "late CRETACEOUS beds", lambda c: extract_age(c, F.lit(None).cast("string"))) == "Cretaceous"


def test_commodities(spark):
    cases = {"AU": (["gold"], ["GOLD"]), " AU CU ": (["gold", "copper"], ["AU", "CU"]), "rare earth": (["rare earth elements"], ["RARE EARTH ELEMENTS"]),
             "Au, cu;AU/xx": (["gold", "copper", "xx"], ["AU", "CU", "XX"]), "NB": (["nb"], ["NB"]), None: ([], [])}
    for text, (names, codes) in cases.items():
        assert (one(spark, text, commodity_names), one(spark, text, commodity_codes)) == (names, codes)
    assert one(spark, ["NB", "rare-earth", "rare earth element", None, "Au+CU"], fused_names, "array<string>") == ["niobium", "rare earth elements", "rare", "earth", "element", "gold", "copper"]
    assert one(spark, ["x", "Gold "], commodity_color, "array<string>") == [218, 165, 32, 190]
    assert one(spark, None, commodity_color, "array<string>") == [52, 152, 219, 165]


def test_registry_rows(spark):
    rows = [("10", "Moonshine", "Occurrence", "u", " AU CU ", "-132.05371", "55.14445"), (" ", "b", None, None, "AU", "1", "1"), ("3", "c", None, None, None, "0", "90.0001"), ("4", "d", None, None, None, "x", "1"), ("5", "e", None, None, None, "0", "90")]
    raw = spark.createDataFrame(rows, "` Dep ID ` string, NAME string, dev_stat string, url string, code_list string, Long string, LAT string")
    df = normalize_registry(raw)
    kept = {r["record_id"]: r for r in valid_registry(df).collect()}
    assert set(kept) == {"10", "5"} and kept["10"]["commod1"] == "AU" and kept["10"]["commodities"] == ["gold", "copper"] and kept["10"]["longitude"] == -132.05371
    assert {tuple(r) for r in dropped_counts(df).collect()} == {("no_id", 1), ("out_of_range", 1), ("no_coordinates", 1)}
    assert enforce_schema(df).columns == UNIFIED.names and empty_unified(spark).count() == 0


def test_constraints(spark):
    rows = [("A", 1.0, 1.0, 1.0, 0.5), ("B", 91.0, 1.0, 1.0, 0.5), ("C", None, None, -1.0, None), ("D", None, None, math.nan, None), ("", None, None, None, None)]
    df = spark.createDataFrame(rows, "record_id string, latitude double, longitude double, tonnage double, confidence_score double")
    good, bad = split_valid(df)
    assert {r[0] for r in good.collect()} == {"A"} and bad.count() == 4
    with pytest.raises(ValueError):
        assert_valid(df)


def test_chunks(spark):
    assert pack_sentences("A b. C d. E.", 9) == ["A b. C d.", "E."]
    long = "x" * 1200
    assert one(spark, long, lambda c: chunk_text(c, 10)) == ["x" * 500, "x" * 500, "x" * 200]
    assert one(spark, None, chunk_text) == [] and one(spark, " \n", chunk_text) == []
    text = " ".join(f"Sentence number {i} ends here." for i in range(200))
    chunks = one(spark, text, lambda c: chunk_text(c, 1))
    assert " ".join(chunks) == text and max(map(len, chunks)) <= 500


def test_similarity_and_names_against_brute_force(spark):
    got = spark.createDataFrame([("Tide", "diet"), ("", "a")], "a string, b string").select(name_similarity(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [25.0, 0.0]
    rng = random.Random(5)
    base = ["".join(rng.choice("abcde") for _ in range(rng.randint(3, 16))) for _ in range(60)]
    twist = [b[:i] + rng.choice("abcde") + b[i + rng.randint(0, 1) :] for b in base for i in (rng.randrange(len(b)),)]
    frame = lambda names: spark.createDataFrame([(i, n, None, None) for i, n in enumerate(names)], "_ord long, site_name string, latitude double, longitude double")
    found = {(r["m_ord"], r["p_ord"]) for r in name_candidates(frame(base), frame(twist), 88.0).collect()}
    want = {(i, j) for i, a in enumerate(base) for j, b in enumerate(twist) if 100 * SequenceMatcher(None, a, b).ratio() >= 88}
    assert found == want


def test_assignment_equals_serving_in_order(spark):
    rng = random.Random(9)
    pairs = sorted({(rng.randrange(25), rng.randrange(25)) for _ in range(150)})
    rows = [(m, p, float(rng.randrange(6))) for m, p in pairs]
    taken, want = set(), set()
    for p in range(25):
        free = [(-s, m) for m, q, s in rows if q == p and m not in taken]
        if free:
            taken.add(min(free)[1])
            want.add((min(free)[1], p))
    got = {(r["m_ord"], r["p_ord"]) for r in assign_one_to_one(spark.createDataFrame(rows, "m_ord long, p_ord long, score double")).collect()}
    assert got == want


def unified(spark, rows):
    return spark.createDataFrame(rows, "_ord long, record_id string, site_name string, latitude double, longitude double, commodities array<string>, source string, confidence_score double, grade double, tonnage double, source_url string")


def test_fusion(spark):
    m = unified(spark, [(0, "1", "Creede", 37.8, -106.9, ["silver"], "mrds", 1.0, None, 5.0, "u"), (1, "2", "Creede", 37.8, -106.9, [], "mrds", 1.0, None, None, None), (2, "3", "Far", 0.0, 0.0, [], "mrds", 1.0, None, None, None)])
    p = unified(spark, [(0, "pdf-1", "Creede", 37.801, -106.9, ["lead", "silver"], "pdf", 0.6, 2.0, 7.0, "v"), (1, "pdf-2", None, None, None, None, "pdf", 0.2, None, None, None)])
    out, parts = build_unified(m, p)
    rows = {r["record_id"]: r for r in out.collect()}
    # the second Creede row is plain mrds, has the same key as the merged one and comes first by source
    assert set(rows) == {"2", "3", "pdf-2"}
    counts = match_counts(out, parts).first().asDict()
    assert (counts["matched"], counts["pre_dedupe_total"], counts["total"], counts["deduped_records"]) == (1, 4, 3, 1)
    assert dedupe(m, "_ord").count() == 2


def test_mentions(spark):
    response = json.dumps({"deposits": [{"site_name": "Red Mountain", "commodities": ["Cu"]}, {"site_name": " "}, {"site_name": "Red Mountains", "latitude": 1.0, "longitude": 2.0, "commodities": ["gold"]}]})
    rows = [("d", 0, response), ("d", 1, "broken"), ("d", 2, json.dumps([{"site_name": "Шахта"}, {"site_name": "Рудник"}])), ("e", 0, None)]
    mentions = explode_mentions(spark.createDataFrame(rows, "doc_id string, chunk_no int, response string"))
    got = {r["cluster"]: r for r in merge_mentions(mentions).collect()}
    assert got[0]["site_name"] == "Red Mountains" and got[0]["commodities"] == ["copper", "gold"] and got[0]["confidence_score"] == 1.0
    assert got[1]["appearances"] == 2 and got[1]["confidence_score"] == pytest.approx(0.3) and len(got) == 2
    prepared = prepare_report_records(merge_mentions(mentions), F.lit("a.pdf"))
    assert prepared.where("cluster = 0").first()["commod2"] == "gold"
    scored = spark.createDataFrame([(1.0, 2.0, ["a"], "x")], "latitude double, longitude double, commodities array<string>, site_name string")
    assert scored.select(confidence(F.lit(1))).first()[0] == 0.9


def test_enrichment(spark):
    shape = bytearray(polygon_wkb([[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]))
    layer = spark.createDataFrame([(1, None, "d", None, None, shape), (2, " Unit  A ", "Eocene granite", " ", None, shape)], "unit_id int, geologic_unit string, geology_description string, geologic_age_raw string, lithology_raw string, geometry binary")
    df = spark.createDataFrame([(0, 1.0, 1.0, "old"), (1, 9.0, 9.0, "old"), (2, None, None, "old"), (3, 0.0, 1.0, "old")], "_ord long, latitude double, longitude double, geologic_unit string")
    got = {r["_ord"]: (r["geologic_unit"], r["lithology"], r["geologic_age"]) for r in spatial_join(df, layer).collect()}
    inside = ("Unit A", "granite", "Eocene")
    assert got == {0: inside, 1: (None, None, None), 2: (None, None, None), 3: inside}


def test_analytics(spark):
    df = unified(spark, [(0, "1", "A", 1.0, 1.0, ["Gold ", "lead"], "mrds", 1.0, None, None, None), (1, "1", "a", 1.0, 1.0, ["gold", ""], None, 1.0, None, None, None), (2, "3", None, 91.0, 1.0, None, "pdf", 1.0, None, None, None)])
    assert [tuple(r) for r in analytics.commodity_counts(df).collect()] == [("gold", 2), ("lead", 1)]
    assert [r[0] for r in analytics.commodity_counts(df, 1, "_ord").collect()] == ["gold"]
    assert analytics.filter_facets(df, ["GOLD"], ages=["x"]).count() == 1
    assert analytics.sample_rows(df, 2).count() == 2 and analytics.map_points(df, 5).count() == 3
    q = analytics.quality_report(df).first()
    assert (q["invalid_coordinates"], q["duplicate_sites"], q["duplicate_ids"], q["missing_names"]) == (1, 1, 1, 1)
    assert analytics.summary(df.limit(0)).first()["matched_percent"] == 0.0


def test_points(spark):
    row = spark.createDataFrame([(1.5, 2.5), (None, 1.0)], "lon double, lat double").select(point(F.col("lon"), F.col("lat")).alias("g")).collect()
    assert bytes(row[0]["g"]) == point_wkb(1.5, 2.5) and row[1]["g"] is None


def test_a_chain_of_reports_is_served_in_order(spark):
    from oreweave.operators.fusion import assign_one_to_one

    # report k likes row k - 1 best and row k second, so each choice waits for the one before
    rows = [(k, k, 60.0) for k in range(1000)] + [(k - 1, k, 70.0) for k in range(1, 1000)] + [(0, 0, 70.0)]
    pairs = spark.createDataFrame(rows, "m_ord long, p_ord long, score double").repartition(7)
    taken, expected = set(), set()
    for p in range(1000):
        best = sorted((-s, m) for m, q, s in rows if q == p and m not in taken)
        if best:
            taken.add(best[0][1])
            expected.add((best[0][1], p))
    for at_once in 2_000_000, 1990:
        got = {(r["m_ord"], r["p_ord"]) for r in assign_one_to_one(pairs, at_once).collect()}
        assert got == expected


def test_assignment_equals_the_serial_one(spark):
    import random

    from oreweave.operators.fusion import assign_one_to_one

    rng = random.Random(2)
    rows = sorted({(rng.randrange(60), rng.randrange(60), float(rng.randrange(4))) for _ in range(900)})
    rows = list({(m, p): (m, p, s) for m, p, s in rows}.values())
    taken, expected = set(), set()
    for p in range(60):
        best = sorted((-s, m) for m, q, s in rows if q == p and m not in taken)
        if best:
            taken.add(best[0][1])
            expected.add((best[0][1], p))
    pairs = spark.createDataFrame(rows, "m_ord long, p_ord long, score double").repartition(5)
    for at_once in 10_000, 100, 0:
        assert {(r["m_ord"], r["p_ord"]) for r in assign_one_to_one(pairs, at_once).collect()} == expected
    assert assign_one_to_one(pairs.limit(0)).count() == 0


def test_ordinals_are_the_same_in_every_evaluation(spark):
    from oreweave.plans.pipelines import ordered

    df = spark.range(30_000).selectExpr("id % 9973 AS a", "repeat('x', cast(id % 50 AS int)) AS wide", "id").repartition(16)
    numbered = ordered(df, "a", "id")
    narrow = {r["id"]: r["_ord"] for r in numbered.select("id", "_ord").collect()}
    assert narrow == {r["id"]: r["_ord"] for r in numbered.select("id", "wide", "_ord").collect()} and len(set(narrow.values())) == 30_000


def test_merging_finds_every_similar_name(spark):
    import random
    from difflib import SequenceMatcher

    from oreweave.functions.text import site_key  # noqa: F401
    from oreweave.operators.reports import merge_mentions

    rng = random.Random(1)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(6, 18))) for _ in range(25)]
    names = [b if rng.random() < 0.3 else b[: (i := rng.randrange(len(b)))] + rng.choice("abcdz") + b[i + rng.randint(0, 1) :] for b in base * 6]
    rng.shuffle(names)
    rows = [("d", 0, i, n, None, None, None, None, None) for i, n in enumerate(names)]
    schema = "doc_id string, chunk_no int, item int, site_name string, latitude double, longitude double, commodities array<string>, grade double, tonnage double"
    records = []
    for n in names:
        home = next((r for r in records if n == r[0] or SequenceMatcher(None, n, r[0]).ratio() >= 0.88), None)
        if home is None:
            records.append([n, 1])
        else:
            home[1] += 1
            home[0] = n if len(n) > len(home[0]) else home[0]
    got = sorted((r["cluster"], r["site_name"], r["appearances"]) for r in merge_mentions(spark.createDataFrame(rows, schema)).collect())
    assert got == [(i, n, k) for i, (n, k) in enumerate(records)]
