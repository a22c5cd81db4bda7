"""Sentence boundaries across languages and scripts (problem 10).

Document-centred disambiguation.  What a full stop after a word means is decided
by that word's unambiguous occurrences in the same document: before a lower-case
word, a digit or a comma its stop marks an abbreviation; a stop at the end of a
paragraph and the word without a stop speak against it.  The same counts over
the whole corpus are the prior that the document's counts start from, and fixed
lists speak only where the corpus is silent.  Whether a capitalised word after
an abbreviation is a name is decided alike: a word in lower case elsewhere in
the document, or else in the corpus, is none.  Terminators, closing marks,
quotations and blanks follow rules of the script.

The corpus counts are one aggregation, combined on the map side.  The words that
they decide are shipped to all tasks while their number is within MOST_SHIPPED;
beyond that they are joined to the documents that use them, with the same result.
"""

from __future__ import annotations

import re as fast
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.session import cut_lineage

#: Unambiguous occurrences, or documents, from which on the corpus is not silent on a word.
LEAST_COUNT = 5
#: How many occurrences in the document the corpus or a list weighs.
PRIOR_WEIGHT = 3.0
#: Prior of words on which nothing is known, and of words that always carry a stop.
UNKNOWN, ALWAYS_DOTTED = 0.1, 0.9
#: Words of the lexicon up to which it travels with the tasks.
MOST_SHIPPED = 300_000

# Fixed values, used where the corpus is silent: titles and references that stand before names or numbers.
TITLES = frozenset(
    "dr mr mrs ms st mt ft prof sr sra srta dra sta sto mm mgr hr fr stn rev gen col capt lt vgl nr bzw abb taf "
    "tab fig figs sec sect app no nos núm pág págs p pp vol ch ca approx aprox env rev см рис табл им ул ок д-р г-н проф акад "
    "डॉ श्री".split()
)
# Fixed values, used where the corpus is silent: function words that start sentences and are no names.
STARTERS = frozenset(
    "the a an she he it they we this that these those there no one in on at as if when after before el la los las un una "
    "le les une il elle ils der die das ein eine er sie es o os um uma он она они это в на".split()
)
# German words after an ordinal number.
ORDINAL_NEXT = frozenset(
    "januar februar märz april mai juni juli august september oktober november dezember jänner jh jhd jahrhundert".split()
)

# Marks of the scripts.
TERMINATORS = ".!?…。！？।॥؟"
OPENING = {"«": "»", "“": "”", "„": "“", "「": "」", "『": "』", "(": ")", "[": "]", "（": "）", "【": "】", "《": "》"}
CLOSERS = "\"'”’»)]）】」』》“"
_BRACKETS = "([（【"
_QUOTES = "«“„\""

_OPENING = fast.compile("[" + fast.escape("".join(OPENING)) + "\"]")
_STOP = fast.compile(r"[.!?…。！？।॥؟]+")
_PARAGRAPH = fast.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+|\f")
_LIST_LINE = fast.compile(r"(?m)^[^\S\n]*(?:[•▪◦‣·*\-–](?=\s)|\(?\d{1,3}\)(?=\s)|\(?[a-z]\)(?=\s))(?=[^\n]*\S)")
_WORDS = fast.compile(r"[^\W\d_]+\.?")
_WORD_BACK = re.compile(r"(?r)[\p{L}\p{M}\p{N}'’\-/]+")
_JOINER = fast.compile(r"[\-'’]")
_WORD_NEXT = fast.compile(r"[\w\u0300-\u036f]+(?:['’][^\W\d_]{2,})?")
_INITIAL = re.compile(r"\p{L}\.(?!\p{L}{2})")
_CJK = re.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")
_NUMBER_CJK = re.compile(r"\d+(?:\.\d+)?[\p{Han}\p{Hiragana}\p{Katakana}]")
_NO_CASE = re.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Arabic}\p{Devanagari}\p{Thai}\p{Hebrew}]")
_HEAD_NUMBER = fast.compile(r"\s*(?:\d+(?:\.\d+)*|[IVXLC]+|[A-Za-z])$")
_THAI = fast.compile("[\u0e00-\u0e7f]")
_THAI_GAP = re.compile(r"(?<=\p{Thai})\s+(?=\S)")
_QUOTE_GOES_ON = fast.compile(r"\s*(?:[—–\-,;:，、；：]|と|って|という)")


_UNSEEN = "\u200b\ufeff"


def _first(text: str, lo: int, hi: int) -> int:
    while lo < hi and (text[lo].isspace() or text[lo] in _UNSEEN):
        lo += 1
    return lo


def _segments(text: str) -> list[tuple[int, int]]:
    """(start, end) of paragraphs, cut before list entries on lines of their own; blank ones left out."""
    out = []
    bounds = [0]
    for m in _PARAGRAPH.finditer(text):
        bounds += m.span()
    bounds.append(len(text))
    entries = [(m.start(), m.group()) for m in _LIST_LINE.finditer(text)]
    k = 0
    for lo, hi in zip(bounds[::2], bounds[1::2]):
        at = seen = lo
        opened = closed = -1
        while k < len(entries) and entries[k][0] < hi:
            start, mark = entries[k]
            k += 1
            if start < lo:
                continue
            opened, closed = max(opened, text.rfind("(", seen, start)), max(closed, text.rfind(")", seen, start))
            seen = start
            # "1)" closes a bracket that is open before it
            if opened > closed and ")" in mark and "(" not in mark:
                continue
            if text[at:start].strip():
                out.append((at, start))
                at = start
        if text[at:hi].strip():
            out.append((at, hi))
    return out


class Document:
    """The stops of one text, and what its unambiguous occurrences say about its words.

    ``stops`` holds (segment, start, end, word, where the word starts, where a run
    of dotted words like "a.m" starts, where the next sign stands).
    """

    def __init__(self, text: str):
        self.text = text
        self.segments = _segments(text)
        self.stops: list[tuple] = []
        #: word -> [stops, stops that show an abbreviation, stops that end a paragraph]
        self.dotted: dict[str, list[int]] = {}
        self._words: set[str] | None = None
        self._known: dict[str, bool] = {}
        dotted, add = self.dotted, self.stops.append
        for k, (lo, hi) in enumerate(self.segments):
            floor, run = lo, -1
            for m in _STOP.finditer(text, lo, hi):
                s, e = m.span()
                nxt = e
                while nxt < hi and ((c := text[nxt]) == " " or c.isspace() or c in _UNSEEN):
                    nxt += 1
                if e > s + 1 or text[s] != ".":
                    add((k, s, e, "", s, s, nxt))
                    floor, run = e, -1
                    continue
                b = text.rfind(" ", floor, s) + 1 or floor
                word = text[b:s]
                if not word.isalpha():
                    found = _WORD_BACK.match(text, floor, s)
                    word = found[0] if found else ""
                    b = s - len(word)
                begin = run if b == floor and run >= 0 else b
                add((k, s, e, word, b, begin, nxt))
                floor, run = e, -1
                if not word.isalpha():
                    continue
                # a word right after this stop goes on with its run
                run = begin
                if nxt == e < hi and text[e] not in ",;:)]" or begin > lo and (text[begin - 1].isalnum() or text[begin - 1] in ".@/-"):
                    continue
                w = text[begin:s].lower()
                n = dotted.get(w)
                if n is None:
                    n = dotted[w] = [0, 0, 0]
                n[0] += 1
                if nxt >= hi:
                    n[2] += 1
                elif (c := text[nxt]) in ",;:" or (nxt > e and (c.islower() or c.isdigit())):
                    n[1] += 1

    @property
    def words(self) -> set[str]:
        """Runs of letters as they stand, with a stop right after them or without."""
        if self._words is None:
            self._words = set(_WORDS.findall(self.text))
        return self._words

    def bare(self, word: str) -> bool:
        """Whether a lower-case word occurs without a stop, in any case."""
        words = self.words
        return word in words or word.capitalize() in words or word.upper() in words

    def lower(self, word: str) -> bool:
        """Whether a lower-case word occurs in lower case."""
        return word in self.words or word + "." in self.words

    def capitals(self) -> tuple[set[str], set[str]]:
        """(asked, starts): words, in lower case, that follow a full stop, or begin a paragraph or follow another terminator, with a capital."""
        text, asked, starts = self.text, set(), set()
        for lo, hi in self.segments:
            at = _first(text, lo, hi)
            if at < hi and text[at].isupper():
                starts.add(_WORD_NEXT.match(text, at)[0].lower())
        for k, s, e, _, _, _, nxt in self.stops:
            if nxt < self.segments[k][1] and text[nxt].isupper():
                (asked if text[s] == "." else starts).add(_WORD_NEXT.match(text, nxt)[0].lower())
        return asked, starts

    def abbreviation(self, word: str, corpus: dict[str, tuple[float, bool]]) -> bool:
        w = word.lower()
        known = self._known.get(w)
        if known is None:
            prior = corpus[w][0] if w in corpus and corpus[w][0] >= 0 else ALWAYS_DOTTED if w in TITLES else UNKNOWN
            _, shown, ends = self.dotted.get(w, (0, 0, 0))
            # the word without a stop weighs two; the text is searched for it only where that decides
            lead = shown + 2 * PRIOR_WEIGHT * prior - ends - PRIOR_WEIGHT
            known = self._known[w] = lead >= 2 or (lead >= 0 and not self.bare(w))
        return known

    def common(self, word: str, corpus: dict[str, tuple[float, bool]]) -> bool:
        """Whether a capitalised word is no name."""
        w = word.lower()
        return word[:1].isupper() and ((w in corpus and corpus[w][1]) or w in STARTERS or self.lower(w))


_COUNTS = ("n", "shown", "ends", "docs", "bare", "lower", "asked", "starts")


def corpus_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n, shown, ends, docs, bare, lower, asked, starts) over all documents.

    n, shown, ends: stops after the word, those that show an abbreviation, those
    that end a paragraph; docs, bare: documents with such a stop, and those of
    them that also hold the word without one; lower: documents that hold the word
    in lower case and without a stop; asked, starts: those in which it follows a full stop, or begins
    a paragraph or follows another terminator, with a capital.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            held: Counter = Counter()
            asked: Counter = Counter()
            starts: Counter = Counter()
            seen: dict[str, list[int]] = {}
            for t in b["text"]:
                if not t or t.isspace():
                    continue
                doc = Document(t)
                held.update(doc.words)
                after, begin = doc.capitals()
                asked.update(after)
                starts.update(begin)
                for w, (n, shown, ends) in doc.dotted.items():
                    c = seen.setdefault(w, [0, 0, 0, 0, 0])
                    c[0] += n
                    c[1] += shown
                    c[2] += ends
                    c[3] += 1
                    c[4] += doc.bare(w)
            lower = Counter({w: n for w, n in held.items() if w[-1] != "." and w.islower()})
            rows = [(w, *seen.get(w, (0, 0, 0, 0, 0)), lower[w], asked[w], starts[w]) for w in {*seen, *lower, *asked, *starts}]
            yield pd.DataFrame(rows, columns=["word", *_COUNTS])

    schema = ", ".join(["word string", *(f"{c} long" for c in _COUNTS)])
    counted = docs.select(F.col(text).alias("text")).mapInPandas(count, schema)
    return counted.groupBy("word").agg(*[F.sum(c).alias(c) for c in _COUNTS])


def corpus_lexicon(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, prior, common): what the corpus says about the words on which it is not silent.

    prior: probability that a stop after the word is part of it, -1 where the
    corpus is silent or sure that it is not.  A word that shows itself as an
    abbreviation has the share of its unambiguous stops; one that never ends a
    paragraph and is hardly ever without a stop in a document that has it with
    one is a title like "Dr." before names.  common: in lower case, or first in
    its sentence beyond doubt, in LEAST_COUNT documents.
    """
    c = {x: F.col(x) for x in _COUNTS}
    share = c["shown"] / (c["shown"] + c["ends"])
    always = (c["docs"] >= 4 * LEAST_COUNT) & (c["ends"] * 200 <= c["n"]) & (c["bare"] * 5 <= c["docs"]) & ~F.col("word").contains(".")
    prior = (
        F.when((c["n"] >= LEAST_COUNT) & (c["shown"] * 2 >= c["n"]), share)
        .when(always, F.lit(ALWAYS_DOTTED))
        .otherwise(-1.0)
    )
    common = ((c["lower"] >= LEAST_COUNT) | (c["starts"] >= LEAST_COUNT)) & (c["asked"] > 0)
    return cut_lineage(
        corpus_counts(docs, text).select("word", prior.alias("prior"), common.alias("common")).where("prior >= 0 or common")
    )


def _ends(doc: Document, stop: tuple, before: tuple | None, at: int, end: int, nxt: int, hi: int, corpus: dict) -> bool:
    """Whether a stop, closed at ``end``, ends the unit begun at ``at``; ``before`` is the stop before it in the unit."""
    text = doc.text
    _, s, e, word, b, run, _ = stop
    if nxt >= hi:
        return True
    gap = nxt - end
    c = text[nxt]
    mark = text[s]
    if mark in "。！？।॥؟":
        return c not in "，、；：,;:—–"
    if e > s + 1 or mark != ".":
        marks = set(text[s:e])
        if marks == {"…"}:
            return gap > 0 and not c.islower() and not _CJK.match(c)
        if marks & {"!", "?"}:
            return c not in ",;:—–"
        # an ellipsis goes on in lower case
        return not c.islower() and c not in ",;:" and not (gap == 0 and c.isdigit())
    if c in ",;:":
        return False
    tail = word if "/" in word or word.isalpha() else _JOINER.split(word)[-1]
    if gap == 0 and end == e:  # no blank: a decimal, a file name, or a lost blank
        if _CJK.match(c) or (c.isdigit() and len(word) > 1 and word.isalpha() and _NUMBER_CJK.match(text, nxt)):
            return bool(word) and not (word.isdigit() and c.isdigit())
        if _NO_CASE.match(c):
            return bool(word)
        if not (c.isupper() or c in "«“„\"¿¡"):
            return False
        if len(tail) == 1 and tail.isupper():
            return False
        if b > at and text[b - 1] in "@/":  # an address
            return False
        return not (tail.isalpha() and doc.abbreviation(tail, corpus))
    if not word:
        return True
    if "\u0900" <= word[-1] <= "\u097f":  # Devanagari ends its sentences otherwise
        return False
    if s - at <= 8 and _HEAD_NUMBER.fullmatch(text, at, s) and len(text[at:s].strip()) <= 6:  # "2.3 Assays": the number of a heading
        return False
    if tail.isdigit():
        following = _WORD_NEXT.match(text, nxt)
        return not (len(tail) <= 2 and following and following[0].lower() in ORDINAL_NEXT)
    dotted = text[run:s] if run < b and len(tail) == 1 else None
    if dotted or (len(tail) == 1 and tail.isalpha()):
        single = (dotted or tail).lower()
        unit = not dotted and tail.islower() and b > at and text[at:b].rstrip()[-1:].isdigit() and not doc.abbreviation(single, corpus)
        if unit:  # a unit of measure after its number
            return True
        if _INITIAL.match(text, nxt) or (c.isdigit() and not _NO_CASE.match(tail)):
            return False  # another initial, or a numbered reference
        if c.islower() or c.isdigit():
            if dotted or (tail.isupper() and c.islower()):
                return False
            return not doc.abbreviation(single, corpus)
        if _NO_CASE.match(tail):
            return True
        # the stop before it, at most a blank away, follows a letter
        close = before is not None and before[2] >= b - 1 and before[3][-1:].isalpha()
        if tail.isupper() or dotted:
            if c in _QUOTES:  # a name stands in no quotation
                return not close
            # a capital initial before a name; "S." or "B." before a number, "z. B." before a noun
            following = _WORD_NEXT.match(text, nxt)
            return bool(following) and len(following[0]) > 1 and doc.common(following[0], corpus) and (bool(dotted) or not close)
        return not (doc.abbreviation(single, corpus) or (close and len(before[3]) == 1 and before[3].islower()))
    if not doc.abbreviation(tail, corpus):
        return True
    if not c.isupper() or _INITIAL.match(text, nxt):
        return False
    if tail.lower() in TITLES and tail.lower() not in corpus:
        return False
    following = _WORD_NEXT.match(text, nxt)
    return bool(following) and doc.common(following[0], corpus)


def _spans(text: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """Quotations and brackets (start, end after the closing mark), outermost only, however long.

    A mark without a partner in its paragraph hides nothing.  A closing mark that
    is not found is not looked for again, so the time is linear.
    """
    spans: list[tuple[int, int]] = []
    gone: set[str] = set()
    past = lo
    for m in _OPENING.finditer(text, lo, hi):
        i = m.start()
        if i < past:
            continue
        mark = OPENING.get(m[0], '"')
        if mark in gone:
            continue
        close = text.find(mark, i + 1, hi)
        if close < 0:
            gone.add(mark)
            continue
        past = close + 1
        spans.append((i, past))
    return spans


def unit_starts(text: str | None, corpus: dict[str, tuple[float, bool]] | None = None) -> list[int]:
    """Offset of the first character of each sentence unit; [] for null and blank texts.

    ``corpus`` maps words to (prior, common) as :func:`corpus_lexicon` finds them.
    """
    if not text or text.isspace():
        return []
    corpus = corpus or {}
    doc = Document(text)
    out: list[int] = []
    stops = doc.stops
    i = 0
    thai = _THAI.search(text) is not None
    for k, (lo, hi) in enumerate(doc.segments):
        at = _first(text, lo, hi)
        if at >= hi:
            while i < len(stops) and stops[i][0] == k:
                i += 1
            continue
        out.append(at)
        entry = _LIST_LINE.match(text, at) if text[at] in "•▪◦‣·*-–(" or text[at].isalnum() else None
        body = entry.end() if entry and entry.end() <= hi else at
        spans = _spans(text, body, hi)
        gaps = [m.end() for m in _THAI_GAP.finditer(text, body, hi)] if thai else ()
        g = n = 0
        before = None
        while i < len(stops) and stops[i][0] == k:
            stop = stops[i]
            i += 1
            s, e, nxt = stop[1], stop[2], stop[6]
            while g < len(gaps) and gaps[g] <= s:
                if gaps[g] > at:
                    at, before = gaps[g], None
                    out.append(at)
                g += 1
            if s < at or s < body:
                continue
            while n < len(spans) and spans[n][1] <= s:
                n += 1
            if n < len(spans) and spans[n][0] <= s:
                q0, q1 = spans[n]
                # only the last stop of a quotation can end its sentence
                if text[q0] in _BRACKETS or q1 - e > 8 or not text[e:q1].strip() or text[e:q1].strip().strip(CLOSERS):
                    continue
                ahead = _first(text, q1, hi)
                if ahead >= hi or _QUOTE_GOES_ON.match(text, q1) or text[s] == "…":
                    continue
                c = text[ahead]
                if c in TERMINATORS:
                    continue
                if at == q0 and not (c.isupper() or c.isdigit() or c in OPENING or c == '"'):
                    continue
                at, before = ahead, None
                out.append(at)
                continue
            end = e
            if e < hi and text[e] in CLOSERS:
                opening = spans[n][0] if n < len(spans) else -1
                while end < hi and text[end] in CLOSERS and end != opening:
                    end += 1
                nxt = _first(text, end, hi)
            if _ends(doc, stop, before, at, end, nxt, hi, corpus):
                before = None
                if nxt < hi:
                    at = nxt
                    out.append(at)
            else:
                before = stop
        for gap in gaps[g:]:
            if gap > at:
                at = gap
                out.append(at)
    return out


def _unit_rows(keys: pd.Series, texts: pd.Series, lexicons: Iterator[dict], key: str) -> pd.DataFrame:
    ids, no, begin, end = [], [], [], []
    for k, t, corpus in zip(keys, texts, lexicons):
        starts = unit_starts(t, corpus)
        ids += [k] * len(starts)
        no += range(len(starts))
        begin += starts
        end += [a + len(t[a:z].rstrip()) for a, z in zip(starts, [*starts[1:], len(t or "")])]
    return pd.DataFrame({key: pd.Series(ids, dtype=keys.dtype), "unit_no": no, "start_char": begin, "end_char": end})


def sentence_units(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, unit_no, start_char, end_char): the sentence units of every document, in order.

    end_char is exclusive and without trailing blanks.  Null, empty and blank
    texts give no row; repeated documents are read as often as they occur; an
    empty table gives an empty result.  Whole texts are read, however long.
    """
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("unit_no", T.IntegerType()),
            T.StructField("start_char", T.IntegerType()),
            T.StructField("end_char", T.IntegerType()),
        ]
    )
    lexicon = corpus_lexicon(docs, text)
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if lexicon.count() <= MOST_SHIPPED:
        words = {r["word"]: (r["prior"], r["common"]) for r in lexicon.toLocalIterator()}
        shipped = docs.sparkSession.sparkContext.broadcast(words)

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield _unit_rows(b["key"], b["text"], iter(lambda: shipped.value, None), key)

        return read.mapInPandas(split, schema)

    # too many words to ship: each document gets its own from a join
    numbered = cut_lineage(read.withColumn("row", F.monotonically_increasing_id()))

    def used(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(r, w) for r, t in zip(b["row"], b["text"]) if t for doc in [Document(t)] for w in {*doc.capitals()[0], *doc.dotted, *(x[3].lower() for x in doc.stops)}]
            yield pd.DataFrame(rows, columns=["row", "word"])

    found = (
        numbered.select("row", "text").mapInPandas(used, "row long, word string").join(lexicon, "word")
        .groupBy("row").agg(F.collect_list(F.struct("word", "prior", "common")).alias("words"))
    )

    def split_own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            own = ({} if w is None else {x["word"]: (x["prior"], x["common"]) for x in w} for w in b["words"])
            yield _unit_rows(b["key"], b["text"], own, key)

    return numbered.join(found, "row", "left").select("key", "text", "words").mapInPandas(split_own, schema)
