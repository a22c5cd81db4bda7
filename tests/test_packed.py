import pytest
from pyspark.sql import functions as F

from oreweave.operators.packed import packed_values, unpack_values

CASES = [
    (None, []), ("", []), ("  ", []), ("n/a", []), ("NULL", []), ("AU", ["AU"]), (" AU CU ", ["AU", "CU"]), ("AU,CU", ["AU", "CU"]),
    ('["AU", "MICA, SHEET"]', ["AU", "MICA, SHEET"]), ("{AU,TI,BI}", ["AU", "TI", "BI"]), ("'CU \"NATIVE\"', 'AU'", ['CU "NATIVE"', "AU"]),
    ('AU|"CU ""NATIVE"""', ["AU", 'CU "NATIVE"']), ("sb, , potash", ["sb", "potash"]), ("n/a; AU", ["AU"]), ("AS and AU", ["AS", "AU"]),
    ("AU - PHO", ["AU", "PHO"]), ("IRON ORE\tSB\tFE", ["IRON ORE", "SB", "FE"]), ('"PB/ZN ORE"', ["PB/ZN ORE"]), ("S\r\nAS\r\nAS", ["S", "AS", "AS"]),
    ("GYP、BA、AU、", ["GYP", "BA", "AU"]), ("0,AU", ["0", "AU"]), ('"AU;CU', ['"AU', "CU"]), ("O'BRIEN, AU", ["O'BRIEN", "AU"]),
]


def test_values_of_cells(spark):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "row_id long, code_list string")
    got = {r["row_id"]: r["v"] for r in df.select("row_id", packed_values(F.col("code_list")).alias("v")).collect()}
    assert [got[i] for i in range(len(CASES))] == [v for _, v in CASES]


def test_rows_positions_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "AU,CU", 7, "x"), (1, "AU,CU", 7, "x"), (2, "AU", 7, "x"), (None, "A;B", 7, "x")], "row_id long, code_list string, pos int, packed_value string")
    got = sorted(map(tuple, unpack_values(df).collect()), key=str)
    assert got == sorted([(1, 1, "AU"), (1, 2, "CU")] * 2 + [(None, 1, "A"), (None, 2, "B")], key=str)
    assert unpack_values(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [5000])
def test_very_long_cell(spark, n):
    df = spark.createDataFrame([(1, ",".join(f'"v, {i}"' for i in range(n)))], "row_id long, code_list string")
    got = unpack_values(df).orderBy("pos").collect()
    assert [r["packed_value"] for r in got] == [f"v, {i}" for i in range(n)] and got[-1]["pos"] == n


def test_plan_is_narrow(spark):
    df = spark.createDataFrame([(1, "AU,CU")], "row_id long, code_list string")
    plan = unpack_values(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_signs_of_the_placeholders_are_ordinary_text(spark):
    cells = ["n\ue003a, gold", "\ue0000\ue001;'a,b';x\ue002", "'q\ue003',n/a,\ue000\ue003"]
    df = spark.createDataFrame(list(enumerate(cells)), "row_id long, code_list string")
    got = {}
    for r in unpack_values(df).orderBy("row_id", "pos").collect():
        got.setdefault(r["row_id"], []).append(r["packed_value"])
    assert got == {0: ["n\ue003a", "gold"], 1: ["\ue0000\ue001", "a,b", "x\ue002"], 2: ["q\ue003", "\ue000\ue003"]}
