import random

from oreweave.llm.aliases import ALIASES, UNLISTED
from oreweave.llm.canonical import Index, allowed_edits, edit_distance, map_values, normalise, unmatched_report, written_values

TERMS = [(i + 1, t, None) for i, t in enumerate(ALIASES["lithology"])]
ROCKS = Index(TERMS, ALIASES["lithology"], UNLISTED["lithology"])
ID = {t: i for i, t, _ in TERMS}


def test_meanings():
    cases = {
        "Kalkstein": "limestone", "花岗岩": "granite", "pale basallt with veinlets": "basalt", "DOLOMITE?": "dolomite", "cgl": "conglomerate",
        "massive sandstoe": "sandstone", "ls.": "limestone", "Mármol ": "marble", "песчаник": "sandstone", "Schiefer (met.)": "schist",
        "black shale": "shale", "stream alluvium": "alluvium", "limolita": "siltstone", "granite (altered)": "granite",
    }
    assert {v: ROCKS.term_of(v)[0] for v in cases} == {v: ID[t] for v, t in cases.items()}
    for v in ("dolerite", "lignite", "limonite", "rock salt", "see sketch", "", "  ", "void.", "xyzzy", "core lost"):
        assert ROCKS.term_of(v)[0] == 0


def test_typing_errors_held_out():
    rng = random.Random(2)
    right = total = 0
    for term, i in ID.items():
        for _ in range(20):
            s = list(term)
            for _ in range(1 if len(s) < 8 else 2):
                k = rng.randrange(1, len(s) - 1)
                kind = rng.randrange(4)
                if kind == 0:
                    s.pop(k)
                elif kind == 1:
                    s.insert(k, s[k])
                elif kind == 2:
                    s[k] = rng.choice("aeilnorst")
                else:
                    s[k], s[k - 1] = s[k - 1], s[k]
            total += 1
            right += ROCKS.term_of("".join(s))[0] == i
    assert right >= 0.97 * total


def test_edit_distance_against_brute_force():
    def slow(a, b):
        if not a or not b:
            return len(a) + len(b)
        best = min(slow(a[1:], b) + 1, slow(a, b[1:]) + 1, slow(a[1:], b[1:]) + (a[0] != b[0]))
        if len(a) > 1 and len(b) > 1 and a[0] == b[1] and a[1] == b[0]:
            best = min(best, slow(a[2:], b[2:]) + 1)
        return best

    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(2))
        assert edit_distance(a, b, 9) == slow(a, b)
    assert edit_distance("abcdef", "xyz", 2) == 3 and allowed_edits(2) == 0 and normalise("  Mármol, ") == "marmol"


def test_tables(spark):
    canon = spark.createDataFrame([(1, "lithology", "granite", None), (2, "geologic_age", "Permian", None), (3, "commodity", "gold", "AU")], "term_id int, kind string, term string, code string")
    observations = spark.createDataFrame([("o1", "granite", "pérmico"), ("o2", "Granit", " "), ("o3", None, "Pergaman"), ("o2", "Granit", None)], "obs_id string, lithology string, geologic_age string")
    reports = spark.createDataFrame([("r1", ["gold", "Au metal", None, "oro"], None), ("r1", ["gold", "Au metal", None, "oro"], None), ("r2", None, None)], "record_id string, commodities array<string>, extracted_at timestamp")
    mapped = map_values(written_values(observations, reports, canon), canon)
    got = sorted((r["record_key"], r["field"], r["pos"], r["term_id"]) for r in mapped.collect())
    assert got == [("o1", "geologic_age", 1, 2), ("o2", "lithology", 1, 1), ("o2", "lithology", 1, 1), ("o3", "geologic_age", 1, 0), ("r1", "commodities", 2, 3), ("r1", "commodities", 4, 3)]
    assert [tuple(r) for r in unmatched_report(mapped).collect()] == [("geologic_age", "Pergaman", 1)]
    assert map_values(written_values(observations.limit(0), reports.limit(0), canon), canon).count() == 0
    clash = spark.createDataFrame([("lithology", None, 9), ("none", "granite", 9), ("lithology", "g" * 100_000, 9)], "kind string, value string, term_id int")
    assert [r["term_id"] for r in map_values(clash, canon).collect()] == [0, 0, 0]
