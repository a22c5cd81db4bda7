"""Splitting oversized texts at natural boundaries with overlap (problem 5).

Every boundary of a text (section start, paragraph, sentence) is joined to its
farthest legal successor: the best boundary that keeps the piece, overlap
included, under the limit.  The table of successors is squared again and again
(pointer doubling), which yields all greedy cuts of a text in log2(pieces) array
steps.  A text is one cell, so its boundaries live in one row's task; texts are
independent and there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.llm.sentences import unit_starts
from oreweave.session import cut_lineage

LIMIT = 6000
OVERLAP = 200
#: Marked sections that make a title known, and titles up to which the list is shipped to the tasks.
LEAST_TITLES = 5
MOST_SHIPPED = 300_000
SECTION, PARAGRAPH, SENTENCE, WORD, HARD = range(5)

_LINE = re.compile(r"[^\n\f\r]*")
#: Section marks that stand before a title on the same line.
_MARKS = re.compile(
    r"""(?x)
    \#{1,6}[ ]+ | §[ ]?\d+(?:\.\d+)*[.:]?[ ]+
    | (?:Section|Chapter|Part|Kapitel|Abschnitt|Teil|Cap[ií]tulo|Secci[oó]n|Se[cç][ãa]o|Parte|Chapitre|Partie
       |Глава|Раздел|Часть|Appendix|Annex|Anhang|Anexo|Ap[eé]ndice|Ap[êe]ndice|Annexe|Приложение)
      [ ]+(?:\d+(?:\.\d+)*|[IVXLC]+|[A-ZА-Я])[ ]?(?:[.:)]|[-–—])?[ ]+
    | 第[ ]?(?:\d+|[一二三四五六七八九十百]+)[ ]?[章节節部编篇][ ：:、]*
    | [一二三四五六七八九十百]+[、．.][ ]?
    | [A-Z]\)[ ]+ | [IVXLC]+\.[ ]+ | \d+(?:\.\d+)+\.?[ ]+ | \d+[.)][ ]+
    """
)
_BARE_MARK = re.compile(r"\d+(?:\.\d+)+\.?[ ]+|\d+[.)][ ]+|[IVXLC]+\.[ ]+|[A-Z]\)[ ]+")
_RUN_IN = re.compile(r"((?:\d+(?:\.\d+)*\.?[ ]+|[IVXLC]+\.[ ]+)?\p{Lu}[\p{Lu}\p{M}’' ]{2,70}\p{Lu})\.[ ]?[-–—][ ]*(?=\S)")
_CAPTION = re.compile(
    r"(?i)(?:table|tab\.|figure|fig\.|plate|map|tabelle|abb\.|abbildung|tafel|tabla|cuadro|figura|tableau|quadro|tabela|"
    r"рис\.|рисунок|таблица|табл\.|図|表|图)[ ]?\d"
)
_LEADERS = re.compile(r"(?:\.[ ]?){3,}[ ]*\d*$|…+[ ]*\d*$|[ ]{3,}\d+$")
_RULE = re.compile(r"[=\-~_*]{3,}$")
#: What ends a sentence cannot end a title; neither can a sentence stand in one.
_PROSE = re.compile(r"[.!?;,:。！？；，：]$|[.!?。！？؟।]\s|[，。；]")
_CONTENTS = frozenset("contents|table of contents|inhalt|inhaltsverzeichnis|índice|contenido|sommaire|table des matières|содержание|目录|目次".split("|"))


def _lines(text: str) -> list[tuple[int, int, str]]:
    out = []
    at = 0
    for m in re.finditer(r"\r\n|[\n\f\r]|$", text):
        line = text[at : m.start()]
        start = at + len(line) - len(line.lstrip())
        out.append((start, m.start(), line.strip()))
        at = m.end()
        if m.end() == len(text) and m.start() == m.end():
            break
    return out


def _is_title(words: str) -> bool:
    """A short nominal line that starts with a capital or an uncased letter and is no sentence."""
    if not words or len(words) > 80 or len(words.split()) > 10:  # a longer line is prose
        return False
    if _PROSE.search(words) or _LEADERS.search(words) or _CAPTION.match(words):
        return False
    first = words[0]
    return first.isalpha() and not first.islower()


def section_starts(text: str | None, title: str | None = None, known: frozenset[str] = frozenset()) -> list[int]:
    """Offsets of the first character of each section heading, its mark included.

    A heading begins a block: a blank line, a page break or the start of the
    text stands before it.  It carries a section mark, is in capitals, is a
    title alone between blank lines or over a rule, or is a title in capitals
    run into its paragraph; a title in ``known`` may also open the text or stand
    right above its paragraph.  Report titles and their repeats on each page,
    contents lists, captions, table lines, list entries, page numbers, notices
    and mentions start no section.  Null and blank texts have none.
    """
    if not text:
        return []
    lines = _lines(text)
    filled = [i for i, x in enumerate(lines) if x[2]]
    if not filled:
        return []
    heads = {re.sub(r"\W+", " ", x).strip().lower() for x in ((title or ""), lines[filled[0]][2]) if x}
    first = filled[0]
    out = []
    for i in filled:
        start, _, line = lines[i]
        if i and lines[i - 1][2]:
            continue
        after = lines[i + 1][2] if i + 1 < len(lines) else ""
        m = _RUN_IN.match(line)
        if m:
            out.append(start)
            continue
        m = _MARKS.match(line)
        rest = line[m.end() :] if m else ""
        if m and _is_title(rest) and not (_BARE_MARK.fullmatch(m[0]) and _LEADERS.search(after)):
            out.append(start)
            continue
        plain = re.sub(r"\W+", " ", line).strip().lower()
        if plain in known and (i != first or plain != re.sub(r"\W+", " ", title or "").strip().lower()):
            out.append(start)
            continue
        if plain in heads or plain in _CONTENTS or re.search(r"\d", line) or not _is_title(line):
            continue
        if _LEADERS.search(after) or "  " in line or "\t" in line or (i == first and after):
            continue
        if line.isupper() and len(line) > 2 and re.search(r"\p{L}{3}", line):
            if i != first:
                out.append(start)
        elif (not after or _RULE.match(after)) and not re.search(r"\p{Han}|\p{Kana}|\p{Thai}", line) and i != first:
            out.append(start)
    return out


def marked_titles(text: str | None) -> list[str]:
    """Titles that carry a section mark on a line of their own, in plain lower case."""
    out = []
    for _, _, line in _lines(text) if text else []:
        m = _MARKS.match(line)
        if m and _is_title(line[m.end() :]):
            out.append(plain_title(line[m.end() :]))
    return out


def plain_title(line: str) -> str:
    return re.sub(r"\W+", " ", line).strip().lower()


def title_lexicon(reports: DataFrame, text: str = "text") -> DataFrame:
    """(title): titles of at least LEAST_TITLES marked sections over all texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: dict[str, int] = {}
            for t in b["text"]:
                for w in marked_titles(t):
                    seen[w] = seen.get(w, 0) + 1
            yield pd.DataFrame(list(seen.items()), columns=["title", "n"])

    counted = reports.select(F.col(text).alias("text")).mapInPandas(count, "title string, n long")
    return cut_lineage(counted.groupBy("title").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_TITLES).select("title"))


def with_titles(reports: DataFrame, titles: DataFrame, key: str, text: str, title: str) -> tuple[DataFrame, Callable[[pd.DataFrame], Iterator[frozenset]]]:
    """(rows key, text, title and perhaps titles; known titles of each row of a batch).

    The known titles of the corpus are shipped to all tasks, or, beyond
    MOST_SHIPPED, joined to the texts that hold such a line, with the same result.
    """
    head = F.col(title) if title in reports.columns else F.lit(None).cast("string")
    rows = reports.select(F.col(key).alias("key"), F.col(text).alias("text"), head.alias("title"))
    if titles.count() <= MOST_SHIPPED:
        shipped = reports.sparkSession.sparkContext.broadcast(frozenset(r["title"] for r in titles.toLocalIterator()))
        return rows, lambda b: (shipped.value for _ in range(len(b)))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held = [(r, w) for r, t in zip(b["row"], b["text"]) if t for w in {plain_title(x[2]) for x in _lines(t)}]
            yield pd.DataFrame(held, columns=["row", "title"])

    own = rows.select("row", "text").mapInPandas(lines, "row long, title string").join(titles, "title").groupBy("row").agg(F.collect_list("title").alias("titles"))
    return rows.join(own, "row", "left").drop("row"), lambda b: (frozenset(() if t is None else t) for t in b["titles"])


def boundaries(text: str, title: str | None = None, known: frozenset[str] = frozenset()) -> tuple[np.ndarray, np.ndarray]:
    """Positions above 0 where a piece may begin, ascending, and the level of each (least is best)."""
    level: dict[int, int] = {}
    for at in unit_starts(text):
        level[at] = SENTENCE
    for m in re.finditer(r"\n[^\S\n]*\n\s*(?=\S)|\f\s*(?=\S)", text):
        level[m.end()] = PARAGRAPH
    for at in section_starts(text, title, known):
        level[at] = SECTION
    level.pop(0, None)
    at = np.array(sorted(level), dtype="i8")
    return at, np.array([level[int(p)] for p in at], dtype="i1")


class _Cuts:
    """Successors of all positions of a text at once, from its boundaries and word starts."""

    def __init__(self, text: str, at: np.ndarray, level: np.ndarray, limit: int, overlap: int):
        self.size, self.limit, self.overlap = len(text), limit, overlap
        blanks = np.array([m.span() for m in re.finditer(r"\s+", text)], dtype="i8").reshape(-1, 2)
        self.blanks = blanks
        self.words = blanks[blanks[:, 1] < len(text), 1]
        self.ranked = [at[level == rank] for rank in (SECTION, PARAGRAPH, SENTENCE)]

    def begins(self, cut: np.ndarray) -> np.ndarray:
        """Where the piece after a cut begins: at the first word at most ``overlap`` before it, if it is near; else exactly there."""
        lo = np.maximum(0, cut - self.overlap)
        run = np.searchsorted(self.blanks[:, 0], lo, "left") - 1
        free = (lo == 0) | ((run >= 0) & (lo <= self.blanks[run, 1])) if len(self.blanks) else lo == 0
        nxt = self._at(self.words, np.searchsorted(self.words, lo, "right"))
        near = (nxt > 0) & (nxt <= lo + self.overlap // 4) & (nxt < cut)
        return np.where(cut == 0, 0, np.where(free | ~near, lo, nxt))

    def ends(self, begin: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Farthest legal end of each piece that begins at ``begin`` and adds text from ``cut`` on."""
        top = begin + self.limit
        found = np.zeros(len(cut), dtype="i8")
        # a section start, or else a paragraph or sentence, that leaves no crumb; then the best of what there is
        for least in (self.limit // 4, self.overlap):
            for boundary in self.ranked:
                last = self._at(boundary, np.searchsorted(boundary, top, "right") - 1)
                found = np.where((found == 0) & (last > cut) & (last >= cut + least), last, found)
        word = self._at(self.words, np.searchsorted(self.words, top, "right") - 1)
        word = np.where(word > np.maximum(cut, top - self.limit // 4), word, top)
        return np.where(top >= self.size, self.size, np.where(found > 0, found, word))

    @staticmethod
    def _at(values: np.ndarray, index: np.ndarray) -> np.ndarray:
        """values[index], 0 outside."""
        if not len(values):
            return np.zeros(len(index), dtype="i8")
        return np.where((index >= 0) & (index < len(values)), values[np.clip(index, 0, len(values) - 1)], 0)


def cut_points(
    text: str, title: str | None = None, limit: int = LIMIT, overlap: int = OVERLAP, known: frozenset[str] = frozenset()
) -> list[tuple[int, int]]:
    """(start, end) of each piece: at most ``limit`` characters, consecutive pieces overlapping.

    Nodes are the boundaries; the successors of all nodes are found at once.  A
    node without a boundary in reach gets a successor at a word or, failing that,
    exactly at the limit, which becomes a node too.
    """
    if len(text) <= limit:
        return [(0, len(text))]
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be under half the limit")
    at, level = boundaries(text, title, known)
    cuts = _Cuts(text, at, level, limit, overlap)
    table = new = np.append(0, at)
    follow = np.zeros(0, dtype="i8")
    known: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(new):  # cuts that are no boundaries become nodes too
        begin = cuts.begins(new)
        end = cuts.ends(begin, new)
        known.append((new, begin, end))
        fresh = np.unique(end[end < len(text)])
        new = fresh[~np.isin(fresh, table)]
        table = np.union1d(table, new)
    order = np.argsort(np.concatenate([k[0] for k in known]))
    start, follow = (np.append(np.concatenate([k[i] for k in known])[order], len(text)) for i in (1, 2))
    table = np.append(table, len(text))
    jump = np.searchsorted(table, follow)
    reached = np.array([0], dtype="i8")
    while True:  # reached covers 2^k cuts from the start; jump is the successor table to the power 2^k
        both = np.union1d(reached, jump[reached])
        if len(both) == len(reached):
            break
        reached = both
        jump = jump[jump]
    return [(int(start[k]), int(table[n])) for k, n in zip(reached, reached[1:])]


def report_sections(
    reports: DataFrame, key: str = "report_id", text: str = "text", title: str = "title", longer_than: int = LIMIT
) -> DataFrame:
    """(key, start_char): the section headings of every text longer than ``longer_than`` characters.

    Nulls in key or title are allowed; null texts give no row; repeated rows are
    read as often as they occur.
    """

    rows, known = with_titles(reports.where(F.length(text) > longer_than), title_lexicon(reports, text), key, text, title)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [(k, s) for k, t, h, w in zip(b["key"], b["text"], b["title"], known(b)) for s in section_starts(t, h, w)]
            yield pd.DataFrame(found, columns=[key, "start_char"])

    schema = T.StructType([T.StructField(key, reports.schema[key].dataType), T.StructField("start_char", T.IntegerType())])
    return rows.mapInPandas(find, schema)


def split_texts(
    reports: DataFrame,
    key: str = "report_id",
    text: str = "text",
    title: str = "title",
    limit: int = LIMIT,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(key, piece_no, start_char, end_char, piece): every text in pieces of at most ``limit`` characters.

    A text within the limit is one piece.  Null and empty texts give no row.
    end_char of a piece lies past the start of the next, so that the pieces
    without their repeated heads join to the text.
    """

    rows, known = with_titles(reports, title_lexicon(reports, text), key, text, title)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pieces = [
                (k, i, a, z, t[a:z])
                for k, t, h, w in zip(b["key"], b["text"], b["title"], known(b))
                if t
                for i, (a, z) in enumerate(cut_points(t, h, limit, overlap, w))
            ]
            yield pd.DataFrame(pieces, columns=[key, "piece_no", "start_char", "end_char", "piece"])

    schema = T.StructType(
        [
            T.StructField(key, reports.schema[key].dataType),
            T.StructField("piece_no", T.IntegerType()),
            T.StructField("start_char", T.IntegerType()),
            T.StructField("end_char", T.IntegerType()),
            T.StructField("piece", T.StringType()),
        ]
    )
    return rows.mapInPandas(split, schema)
