import math
import random
from difflib import SequenceMatcher

import numpy as np

from oreweave.operators import fusion
from oreweave.operators.nearest import _codes, _masks, subsequence

SCHEMA = "_ord long, site_name string, latitude double, longitude double"


def km(a, b):
    if None in a or None in b:
        return None
    (la, lo), (lb, lp) = a, b
    h = math.sin(math.radians(lb - la) / 2) ** 2 + math.cos(math.radians(la)) * math.cos(math.radians(lb)) * math.sin(math.radians(lp - lo) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))


def served(rows, reports, within=50.0):
    """The pairs that serving reports in order chooses from all rows, and the number of pairs alike or near."""
    taken, out, met = set(), set(), 0
    for p, key, *at in reports:
        wants = []
        for m, name, *here in rows:
            d = km(here, at)
            s = 100.0 * SequenceMatcher(None, name, key).ratio() if name and key else 0.0
            if s >= 88 or d is not None and d <= within:
                met += 1
                wants.append((-round(s + 50 - min(d or 50, 50), 9), m))
        free = [w for w in sorted(wants) if w[1] not in taken]
        if free:
            taken.add(free[0][1])
            out.add((free[0][1], p))
    return out, met


def world(seed, rows, reports):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdef") for _ in range(rng.randint(0, 14))) for _ in range(40)] + ["q" * 70 + "ab", "q" * 71 + "b"]
    # crowded places over the 180th meridian and far ones; some without a position, some on the same spot
    place = lambda: rng.choice([(10 + rng.random() / 2, 179.8 + rng.random() / 5), (10 + rng.random() / 2, -180 + rng.random() / 5), (10.25, 179.9), (-40 + rng.random(), rng.random()), (None, None)])
    make = lambda n: [(i, rng.choice(names), *place()) for i in range(n)]
    return make(rows), make(reports)


def test_lists_of_best_rows_give_what_all_pairs_give(spark):
    for seed, many, asked, within in (1, 120, 60, 50.0), (2, 30, 90, 50.0), (3, 80, 60, 20.0):
        rows, reports = world(seed, many, asked)
        expected, _ = served(rows, reports, within)
        for wanted in (1, 3) if seed == 1 else (1,):
            got = fusion.match_records(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(reports, SCHEMA), 88.0, within, wanted)
            assert {(r["m_ord"], r["p_ord"]) for r in got.collect()} == expected


def test_a_crowded_district_is_matched_without_all_its_pairs(spark, monkeypatch):
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(6, 14)))
    make = lambda n: [(i, name(), 30 + rng.random() / 4, 20 + rng.random() / 4) for i in range(n)]
    rows, reports = make(500), make(120)
    listed, assign = [], fusion.assign_one_to_one
    monkeypatch.setattr(fusion, "assign_one_to_one", lambda pairs, *more: listed.append(pairs.count()) or assign(pairs, *more))
    got = fusion.match_records(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(reports, SCHEMA)).collect()
    expected, met = served(rows, reports)
    assert {(r["m_ord"], r["p_ord"]) for r in got} == expected and met == 60_000 and sum(listed) < 0.05 * met


def test_the_common_subsequence_bounds_the_similarity():
    rng = random.Random(4)
    keys = ["".join(rng.choice("abc09") for _ in range(rng.choice([0, 1, 5, 20, 64, 90]))) for _ in range(60)]
    codes, size = _codes(keys)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    common = subsequence(codes, size, left, np.stack([_masks(k) for k in keys]), right)
    for i, j, c in zip(left, right, common):
        a, b = keys[i], keys[j]
        over = max(0, len(a) - 64) + max(0, len(b) - 64)
        assert sum(x.size for x in SequenceMatcher(None, a, b).get_matching_blocks()) <= c + over
        if not over:
            row = [0] * (len(b) + 1)
            for x in a:
                row = [0, *lcs_row(row, x, b)]
            assert c == row[-1]


def lcs_row(row, x, b):
    last = 0
    for k, y in enumerate(b):
        last = row[k] + 1 if x == y else max(row[k + 1], last)
        yield last


def test_a_crowded_district_is_united_without_all_its_pairs(spark, monkeypatch):
    rng = random.Random(6)
    name = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(6, 14)))
    make = lambda n, source: [(i, f"{source}{i}", name(), 30 + rng.random() / 4, 20 + rng.random() / 4, ["gold"], source, 1.0, None, None, "u") for i in range(n)]
    rows, reports = make(200, "mrds"), make(50, "pdf")
    schema = "_ord long, record_id string, site_name string, latitude double, longitude double, commodities array<string>, source string, confidence_score double, grade double, tonnage double, source_url string"
    listed, assign = [], fusion.assign_one_to_one
    monkeypatch.setattr(fusion, "assign_one_to_one", lambda pairs, *more: listed.append(pairs.count()) or assign(pairs, *more))
    unified, parts = fusion.build_unified(spark.createDataFrame(rows, schema), spark.createDataFrame(reports, schema))
    expected, met = served([(r[0], *r[2:5]) for r in rows], [(r[0], *r[2:5]) for r in reports])
    assert {(r["m_ord"], r["p_ord"]) for r in parts["pairs"].collect()} == expected and met == 10_000 and sum(listed) < 0.1 * met
    counts = fusion.match_counts(unified, parts).first()
    assert (counts["matched"], counts["unmatched_mrds_pre_dedupe"], counts["unmatched_pdf_pre_dedupe"], counts["total"]) == (50, 150, 0, 200)


def test_names_are_searched_once_and_a_round_has_three_plans(spark, monkeypatch):
    rows, reports = world(2, 30, 90)
    called = {}
    for name in ("_alike", "best_near", "cut_lineage"):
        called[name] = 0

        def counted(*args, f=getattr(fusion, name), name=name, **more):
            called[name] += 1
            return f(*args, **more)

        monkeypatch.setattr(fusion, name, counted)
    got = fusion.match_records(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(reports, SCHEMA))
    assert {(r["m_ord"], r["p_ord"]) for r in got.collect()} == served(rows, reports)[0]
    # the sides, the keys asked for and the pairs by name come before the rounds
    assert called["_alike"] == 1 and called["best_near"] > 1 and called["cut_lineage"] <= 4 + 3 * called["best_near"]


def test_the_counters_put_the_records_together_once(spark):
    schema = "_ord long, record_id string, site_name string, latitude double, longitude double, commodities array<string>, source string, confidence_score double, grade double, tonnage double, source_url string"
    make = lambda source, *at: [(i, f"{source}{i}", f"site{i % 5}", x, x, ["gold"], source, 1.0, None, None, "u") for i, x in enumerate(at)]
    rows, reports = make("mrds", 1.0, 2.0, 3.0, 4.0, 5.0, 1.0, 2.0), make("pdf", 1.0, 30.0, None)
    sides = spark.createDataFrame(rows, schema), spark.createDataFrame(reports, schema)
    unified, parts = fusion.build_unified(*sides)
    counts = fusion.match_counts(unified, parts)
    got = counts.first().asDict()
    together = {x["_part"]: x["count"] for x in parts["together"].groupBy("_part").count().collect()}
    assert got["matched"] == parts["pairs"].count() == together[0]
    assert (got["unmatched_mrds_pre_dedupe"], got["unmatched_pdf_pre_dedupe"]) == (together.get(1, 0), together.get(2, 0))
    assert (got["input_mrds"], got["input_pdf"], got["pre_dedupe_total"], got["total"]) == (7, 3, sum(together.values()), unified.count())
    assert got["deduped_records"] == got["pre_dedupe_total"] - got["total"] > 0
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2 and "Cross" not in plan
