import pytest

from oreweave.llm import sentences
from oreweave.llm.sentences import corpus_lexicon, sentence_units, unit_starts

LEXICON = {w: (1.0, False) for w in "fig no sec ca approx fm corp ltd vs i.e e.g a.m incl jan oct г т е д др usw ej ex".split()}


def units(text, lexicon=LEXICON):
    starts = unit_starts(text, lexicon)
    return [text[a:z].strip() for a, z in zip(starts, [*starts[1:], len(text)])]


@pytest.mark.parametrize(
    "parts",
    [
        ["The Vorn Fm. overlies shale ca. 26.3 km off (Fig. 74).", "A pit by Mt. Stu reached 27.2 m."],
        ["The pumps ran by 6 a.m. each day.", "iron stain covers the cut."],
        ["Dr. Tae arrived at 7 p.m.", "She left before dawn."],
        ['The foreman noted: "Water is rising. Pull the pumps."', "The crew left."],
        ['"Is it ore? Ask the lab," reads the card No. 36.', "What now?!", "The road is gone."],
        ["«Вода прибывает. Несите насосы!» — крикнул мастер.", "В 2055 г. скважина закрыта и т. д. по склону."],
        ["« Il n'y a plus d'eau ! » a crié le foreur.", "M. Zolurk a levé 519 m."],
        ["Am 3. Mai 2047 fiel das Feld, z. B. an der Mühle.", "Der Gang ist ca. 33,3 km lang."],
        ["Recovery fell to 16 percent... then it rose.", "Version 2.285.1 is out."],
        ["La empresa S.A. tiene agua.", "¿Sigue abierta?", "¡Cuidado con el pozo!"],
        ["औसत मान 36.0 ग्राम है।", "डॉ. Krenzeim ने नमूने लिए।"],
        ['قال المشرف: "الماء يرتفع. أحضروا المضخات."', "ثم غادر الجميع."],
    ],
)
def test_spaced_scripts(parts):
    assert units(" ".join(parts)) == parts


def test_scripts_without_blanks():
    assert units("注意旧竖井！工长说：“水位在上涨。快拿水泵。”随后大家撤离。2042年重新取样……结果偏低。") == ["注意旧竖井！", "工长说：“水位在上涨。快拿水泵。”", "随后大家撤离。", "2042年重新取样……结果偏低。"]
    assert units("監督は「水だ。来い。」と言った。終わり。") == ["監督は「水だ。来い。」と言った。", "終わり。"]
    assert units("ปล่องเก่า ถนนขาด\nสายแร่") == ["ปล่องเก่า", "ถนนขาด", "สายแร่"]


def test_headings_lists_wraps_and_lost_blanks():
    text = "2.3 Assays\n\nNothing else was\nfound\n\nThe sump is dry. \n• bags 1 to 2\n1) repair it\n\nThe road is gone.The adit held."
    assert units(text) == ["2.3 Assays", "Nothing else was\nfound", "The sump is dry.", "• bags 1 to 2", "1) repair it", "The road is gone.", "The adit held."]
    assert unit_starts("  \n x.") == [4]
    assert unit_starts(None) == unit_starts("") == unit_starts(" \n\t") == []


def test_lexicon_is_learned_from_the_corpus(spark):
    docs = [(i, f"The Qf. {i} held water. The end. See qf. b again. It is water here! Xr. Zolu{i} left.") for i in range(30)]
    lexicon = {r["word"]: (r["prior"], r["common"]) for r in corpus_lexicon(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert lexicon["qf"] == (1.0, False)
    # always with a stop before a capital, never at the end: a title
    assert lexicon["xr"][0] == sentences.ALWAYS_DOTTED
    assert "water" not in lexicon and "it" not in lexicon and lexicon["the"][1] and "zolu3" not in lexicon


def test_document_overrules_corpus_and_lists():
    # in this document "fig" stands without a stop and ends paragraphs
    text = "He ate a fig.\n\nA ripe fig.\n\nOne more fig. Trees grow here. The fig tree. A fig."
    assert units(text) == ["He ate a fig.", "A ripe fig.", "One more fig.", "Trees grow here.", "The fig tree.", "A fig."]
    # unknown to corpus and lists, shown here
    assert units("The Krx. 1 and Krx. 2, then Krx. 3 and the Krx. Zolu bed.", {}) == ["The Krx. 1 and Krx. 2, then Krx. 3 and the Krx. Zolu bed."]


def test_names_and_common_words_after_an_abbreviation():
    assert units("Zolu Corp. Drilling went on.", {"corp": (1.0, False), "drilling": (-1.0, True)}) == ["Zolu Corp.", "Drilling went on."]
    assert units("Zolu Corp. Drilling went on.", {"corp": (1.0, False)}) == ["Zolu Corp. Drilling went on."]
    assert units("Zolu Corp. Drilling went on. They stopped drilling.", {"corp": (1.0, False)}) == ["Zolu Corp.", "Drilling went on.", "They stopped drilling."]


@pytest.mark.parametrize("n", [60, 120, 12_000])
def test_quotations_of_any_length(n):
    quote = 'He said: "' + "This is short. " * n + 'The end." '
    assert units(quote + "Then he left. Next one came.") == [quote.strip(), "Then he left.", "Next one came."]
    bracket = "He left (" + "this is short. " * n + "the end). "
    assert units(bracket + "Next one came.") == [bracket.strip(), "Next one came."]


def test_time_is_linear():
    import time

    for piece in ("A. B. ", '(a. "b? c ', "a.", "(", "x", "1) x\n", '"', "「", "Ab. ", "\n"):
        began = time.time()
        unit_starts(piece * (300_000 // len(piece)) + " End. A")
        assert time.time() - began < 20


def test_a_large_lexicon_is_joined(spark, monkeypatch):
    docs = [(i % 7, f"The Qf. {i} held water. Dr. Zolu{i} left it. See Qf. Zolu{i}. The end is near Qf. The pit.") for i in range(40)] + [(None, None), (3, " ")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = []
    for most in 1000, 0:
        monkeypatch.setattr(sentences, "MOST_SHIPPED", most)
        found.append(sorted(map(str, sentence_units(df).collect())))
    assert found[0] == found[1] and len(found[0]) > 100


def test_tables_and_long_texts(spark):
    rows = [(1, "One. Two.", 5), (1, "One. Two.", 5), (2, None, 5), (3, "  ", 5), (None, "A b. " * 50_000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start_char int")
    got = sentence_units(df).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {1: 4, None: 50_000}
    assert sentence_units(df.limit(0)).count() == 0
    assert len(unit_starts("(a. \"b? c " * 20_000)) >= 1
