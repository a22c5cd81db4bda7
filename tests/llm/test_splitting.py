import random

from oreweave.llm.splitting import cut_points, report_sections, section_starts, split_texts

TEXT = """SKEVI CLAIMS REPORT 2031

Contents
1. Access ............ 1
2. Mine Workings ..... 4

1. Access
The adit is open. It was seen.

Table 4. Assay results
HOLE  FROM  TO
V-1  1.0  2.0

DO NOT SCALE FROM THIS SKETCH.

CLOSURE COSTS. - The costs are low.

1. bags 4 to 6.
2. repair the sump.

Section 5 of the old ledger repeats these values.


- 2 -
Skevi Claims Report 2031

§ 2 Mine Workings

Hydrology
=========

The water rises.

第3章 水文

GEOPHYSICS

B) Assay Methods
Text follows.
"""


def test_headings():
    known = frozenset({"access"})
    found = [TEXT[a:].split("\n")[0][:16] for a in section_starts(TEXT, "Skevi Claims Report 2031", known)]
    assert found == ["1. Access", "CLOSURE COSTS. -", "§ 2 Mine Working", "Hydrology", "第3章 水文", "GEOPHYSICS", "B) Assay Methods"]
    assert section_starts(None) == section_starts("") == section_starts(" \n ") == []
    assert section_starts("Access\nThe adit.", None, known) == [0] and section_starts("Access\nThe adit.") == []


def check(text, pieces, limit, overlap):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    assert all(0 < z - a <= limit for a, z in pieces)
    for (a, z), (b, y) in zip(pieces, pieces[1:]):
        assert a < b <= z < y and z - b <= overlap
        assert z - b >= overlap - overlap // 4 - 1


def test_pieces_cover_and_overlap():
    rng = random.Random(3)
    for _ in range(60):
        words = [rng.choice(["rock ", "vein. ", "The adit ", "\n\n", "\n\n1. Access\nIt ", "x" * 40, "水文。"]) for _ in range(rng.randint(50, 900))]
        text = "".join(words)
        check(text, cut_points(text, None, 600, 40), 600, 40)
    for text in ("x" * 50_000, "a b. " * 20_000, " " * 20_000, "字" * 20_000):
        check(text, cut_points(text), 6000, 200)
    assert cut_points("short") == [(0, 5)]


def test_cut_at_sections_first():
    body = "The adit is open to the east side. " * 90
    text = f"1. Access\n{body}\n\n2. Costs\n{body}\n\n3. Water\n{body}"
    starts = set(section_starts(text))
    assert all(z in starts for _, z in cut_points(text)[:-1])


def one_by_one(text, limit, overlap):
    """The same greedy cuts, each found by trying all ends of its piece."""
    import oreweave.llm.splitting as s

    at, level = s.boundaries(text)
    kind = dict(zip(at.tolist(), level.tolist()))
    word = [False] + [text[k - 1].isspace() and not text[k].isspace() for k in range(1, len(text))]
    cut, out = 0, []
    while cut < len(text):
        begin = max(0, cut - overlap) if cut else 0
        if begin and not text[begin - 1].isspace():
            begin = next((k for k in range(begin + 1, min(cut - 1, begin + overlap // 4) + 1) if word[k]), begin)
        top = begin + limit
        end = len(text) if top >= len(text) else None
        for least in (limit // 4, overlap):
            for rank in (s.SECTION, s.PARAGRAPH, s.SENTENCE):
                if end is None:
                    end = next((k for k in range(top, max(cut, cut + least - 1), -1) if kind.get(k) == rank), None)
        if end is None:
            end = next((k for k in range(top, max(cut, top - limit // 4), -1) if word[k]), top)
        out.append((begin, end))
        cut = end
    return out


def test_greedy_cuts_equal_following_one_by_one():
    rng = random.Random(5)
    for _ in range(40):
        words = [rng.choice(["rock ", "vein. ", "The adit ", "\n\n", "\n\n1. Access\nIt ", "x" * 40, "水文。", "y" * 700]) for _ in range(rng.randint(30, 300))]
        text = "".join(words)
        if len(text) > 600:
            assert cut_points(text, None, 600, 40) == one_by_one(text, 600, 40)


def test_many_titles_are_joined_with_the_same_result(spark, monkeypatch):
    import oreweave.llm.splitting as s

    body = "The adit is open to the east side. " * 200
    rows = [(str(i), f"1. Water level\n{body}\n\nWater level\n{body}", "T") for i in range(6)] + [("n", None, None), ("t", f"Water level\n{body}", None)]
    df = spark.createDataFrame(rows, "report_id string, text string, title string")
    found = []
    for most in 1000, 0:
        monkeypatch.setattr(s, "MOST_SHIPPED", most)
        found.append((sorted(map(str, report_sections(df).collect())), sorted(map(str, split_texts(df).collect()))))
    assert found[0] == found[1] and any("report_id='t'" in r for r in found[0][0])


def test_tables(spark):
    rows = [("a", TEXT * 20, None, 1), ("b", None, "t", 1), ("c", "", "t", 1), (None, "short", None, 1), ("a", TEXT * 20, None, 1)]
    df = spark.createDataFrame(rows, "report_id string, text string, title string, start_char int")
    pieces = split_texts(df).collect()
    assert {r["report_id"] for r in pieces} == {"a", None} and all(len(r["piece"]) <= 6000 for r in pieces)
    sections = report_sections(df).groupBy("report_id").count().collect()
    assert len(sections) == 1 and sections[0]["report_id"] == "a"
    assert split_texts(df.drop("title").limit(0)).count() == 0
