import datetime

import pytest

from oreweave.llm.survivorship import discover_truth, surviving_records, surviving_statements

SCHEMA = "statement_id long, record_id string, latitude double, longitude double, source string, confidence_score double, grade string, grade_unit string, tonnage string, tonnage_unit string, remarks string, reported_at timestamp, trust_rank int"
DAY = datetime.datetime(2024, 1, 1)


def row(i, record, source="a", conf=0.5, day=0, lat=None, tonnage=None, grade=None):
    return (i, record, lat, None, source, conf, grade, None, tonnage, None, None, DAY + datetime.timedelta(days=day), 0)


@pytest.fixture
def sources(spark):
    return spark.createDataFrame([("a", 1, "tonne", "g/t"), (" B ", 2, "tonne", "g/t")], "source string, trust_rank int, tonnage_unit string, grade_unit string")


def test_order_of_trust(spark, sources):
    rows = [
        row(1, "x", "b", 0.9, tonnage="5"), row(2, " x ", " A", 0.1, tonnage="7"), row(3, "x", "a", None, 9, tonnage="8"), row(4, "x", "a", 1.5, 9, tonnage="9"),
        row(5, "y", "zz", 1.0, tonnage="-1", grade="3"), row(6, "y", None, 1.0, 0, grade="4"), row(7, "y", "b", 0.2, 5, grade="5"), row(8, "y", "b", 0.2, 6, grade="6"), row(9, "y", "b", 0.2, 6, grade="6"),
        row(10, "lone", tonnage="1"), row(11, None, tonnage="1"), row(12, "z", lat=float("nan")), row(13, "z", lat=1.0, conf=0.1),
    ]
    got = {(r["record_id"], r["field"]): r["statement_id"] for r in surviving_statements(spark.createDataFrame(rows, SCHEMA), sources).collect()}
    assert got == {("x", "tonnage"): 2, ("y", "grade"): 8, ("z", "latitude"): 13}
    assert surviving_statements(spark.createDataFrame([], SCHEMA), sources).count() == 0


def test_truth_discovery_finds_the_reliable_source(spark):
    claims = [(f"d{i}", "tonnage", s, 100.0 + i if s != "bad" or i % 5 == 0 else 500.0 + 7 * i) for i in range(60) for s in ("good", "fair", "bad")]
    claims += [("d0", "tonnage", None, None), ("e", "tonnage", None, 5.0), ("e", "tonnage", "good", 0.0)]
    values, trust = discover_truth(spark.createDataFrame(claims, "record_id string, field string, source_key string, value double"), digits=3)
    reliability = {r["source_key"]: r["reliability"] for r in trust.collect()}
    assert reliability["bad"] < 0.5 < 0.9 < min(reliability["good"], reliability["fair"])
    got = {r["record_id"]: r["value"] for r in values.collect()}
    assert all(got[f"d{i}"] == 100.0 + i for i in range(60)) and got["e"] == 0.0


def test_records(spark, sources):
    rows = [row(1, "x", tonnage="2,000 lb", lat=1.0), row(2, "x", "b", tonnage="907.18474 kg", grade="1 oz/ton")]
    r = surviving_records(spark.createDataFrame(rows, SCHEMA), sources).first()
    assert (r["tonnage"], r["grade_statement"], r["latitude"]) == (pytest.approx(0.90718474), 2, 1.0) and r["tonnage_agreed"]


def test_discovery_chooses_where_no_order_exists(spark, sources):
    # only unranked sources: two agree, a third is more confident
    rows = [row(1, "x", "u", 0.9, tonnage="50"), row(2, "x", "v", 0.2, tonnage="7"), row(3, "x", "w", 0.3, tonnage="7")]
    # a ranked source leads whatever the votes
    rows += [row(4, "y", "a", 0.1, tonnage="50"), row(5, "y", "v", 0.9, tonnage="7"), row(6, "y", "w", 0.9, tonnage="7"), row(7, "y", None, tonnage="-1")]
    rows = [(*r[:9], "tonne" if r[8] else None, *r[10:]) for r in rows]
    got = {r["record_id"]: r for r in surviving_records(spark.createDataFrame(rows, SCHEMA), sources).collect()}
    assert (got["x"]["tonnage"], got["x"]["tonnage_statement"], got["x"]["tonnage_agreed"]) == (7.0, 3, True)
    assert (got["y"]["tonnage"], got["y"]["tonnage_statement"], got["y"]["tonnage_agreed"]) == (50.0, 4, False)
    assert surviving_records(spark.createDataFrame([], SCHEMA), sources).count() == 0


def test_many_sources_are_joined_with_the_same_result(spark, monkeypatch):
    from oreweave.llm import survivorship

    claims = [(f"d{i % 9}", "grade", f"s{i % 13}", float(i % 4)) for i in range(200)]
    df = spark.createDataFrame(claims, "record_id string, field string, source_key string, value double")
    found = []
    for most in 1000, 5:
        monkeypatch.setattr(survivorship, "MOST_IN_PLAN", most)
        values, trust = discover_truth(df)
        found.append((sorted((r["record_id"], r["value"], r["n_claims"]) for r in values.collect()), sorted((r["source_key"], round(r["reliability"], 9)) for r in trust.collect())))
    assert found[0] == found[1]
