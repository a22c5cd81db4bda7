import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oreweave.operators.units import agreeing_pairs, harmonise, parse_number, read_cell, remark_unit, unit_factor

SCHEMA = "statement_id long, record_id string, source string, remarks string, tonnage string, tonnage_unit string, grade string, grade_unit string"
SOURCES = [("mrds", 2, "tonne", "g/t"), ("ledger", 5, "pound", "lb/short ton")]


@pytest.mark.parametrize(
    "cell,number,unit",
    [
        ("922.59 Mlb @ 0.8% Cu", 922.59, "mlb"), ("66 062 000 ton", 66062000.0, "ton"), ("est. 4,048,900 metric tons", 4048900.0, "metric tons"),
        ("1.250.000", 1250000.0, None), ("12,935", 12935.0, None), ("3,2", 3.2, None), ("1.234,5 t", 1234.5, "t"), ("2.0910e+09 lb", 2.091e9, "lb"),
        ("464'950tons", 464950.0, "tons"), ("0", 0.0, None), ("715.32 000 long tons", 715.32, "000 long tons"),
    ],
)
def test_cells(spark, cell, number, unit):
    got = spark.createDataFrame([(cell,)], "c string").select(read_cell(F.col("c"), "tonnage").alias("r")).first()["r"]
    assert (got["number"], got["unit"]) == (pytest.approx(number), unit)


def test_cells_that_state_nothing(spark):
    df = spark.createDataFrame([(c,) for c in (None, "", " ", "-1", "-999", "NaN", "not stated", "-", "n/a")], "c string")
    assert df.where(read_cell(F.col("c"), "tonnage").isNotNull()).count() == 0


def test_factors(spark):
    def factor(unit, field):
        return spark.createDataFrame([(unit,)], "u string").select(unit_factor(F.col("u"), field)).first()[0]

    assert factor("Long Tons", "tonnage") == pytest.approx(1.0160469088)
    assert factor("million lb", "tonnage") == pytest.approx(453.59237)
    assert factor("000 t", "tonnage") == 1000 and factor("kilotonne", "tonnage") == 1000
    assert factor("oz/ton", "grade") == pytest.approx(34.2857, rel=1e-4)
    assert factor("lb/short ton", "grade") == pytest.approx(500)
    assert factor("ppb", "grade") == 0.001 and factor("wt%", "grade") == 1e4 and factor("furlong", "grade") is None


def test_remarks(spark):
    text = "Tonnage given as lb by the operator. Assay values in oz/ton."
    row = spark.createDataFrame([(text,)], "r string").select(remark_unit(F.col("r"), "tonnage"), remark_unit(F.col("r"), "grade")).first()
    assert tuple(row) == ("lb", "oz/ton")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 10**12), min_size=1, max_size=30))
def test_grouped_numbers_round_trip(spark, numbers):
    texts = [f(n) for n in numbers for f in (str, lambda n: f"{n:,}", lambda n: f"{n:,}".replace(",", "'"), lambda n: f"{n:,}".replace(",", " "))]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(parse_number(F.col("t"))).collect()]
    assert got == [float(n) for n in numbers for _ in range(4)]


def test_pairs_against_brute_force(spark):
    cells = ["1000 t", "1,000,000 kg", "1003 t", "1006 t", "2204622.6 lb", "984.2 long tons", "0", "0 t", None, "7", "1000 t"]
    rows = [(i, " A " if i % 2 else "A", "mrds", None, c, None, None, None) for i, c in enumerate(cells)] + [(50, "B", "mrds", None, "1000 t", None, None, None), (51, None, "mrds", None, "1000 t", None, None, None)]
    statements, sources = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(SOURCES, "source string, trust_rank int, tonnage_unit string, grade_unit string")
    got = {tuple(r) for r in agreeing_pairs(harmonise(statements, sources)).collect()}
    value = {0: 1000, 1: 1000, 2: 1003, 3: 1006, 4: 2204622.6 * 0.45359237 / 1000, 5: 984.2 * 1.0160469088, 6: 0, 7: 0, 9: 7, 10: 1000}
    want = {
        (a, b, "tonnage") for a in value for b in value
        if a < b and max(value[a], value[b]) <= min(value[a], value[b]) * 1.005 and cells[a] != cells[b]
    }
    assert got == want


def test_units_without_evidence_fit_the_deposit(spark):
    rows = [(1, "A", "mrds", None, "1000 t", None, None, None), (2, "A", "x", None, "2204.6", None, None, None), (3, "B", "x", None, "5", None, None, None)]
    sources = spark.createDataFrame(SOURCES, "source string, trust_rank int, tonnage_unit string, grade_unit string")
    got = {r["statement_id"]: r for r in harmonise(spark.createDataFrame(rows, SCHEMA), sources).collect()}
    assert got[2]["inferred"] and got[2]["unit"] == "thousand pounds" and got[2]["value"] == pytest.approx(1000, rel=1e-3) and got[2]["unique"]
    assert got[3]["value"] is None and not got[3]["unique"]


def test_source_habit_column_and_empty(spark):
    rows = [(1, "A", " LEDGER ", None, "2204.6", "kg", None, None), (2, "A", "ledger", None, "2,204.6", None, None, None)]
    sources = spark.createDataFrame(SOURCES, "source string, trust_rank int, tonnage_unit string, grade_unit string")
    statements = spark.createDataFrame(rows, SCHEMA)
    got = {r["statement_id"]: (r["evidence"], round(r["value"], 3)) for r in harmonise(statements, sources).collect()}
    assert got == {1: ("column", 2.205), 2: ("source", 1.0)}
    assert agreeing_pairs(harmonise(statements.limit(0), sources)).count() == 0
