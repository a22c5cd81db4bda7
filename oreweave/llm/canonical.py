"""Mapping free-entered values to a canonical list (problem 3).

Values are normalised and looked up by a character n-gram inverted index over
the canonical terms, their codes and their other names.  A candidate is scored
by the cosine of its inverse-frequency weighted n-grams; candidates above a
threshold are verified by their edit distance, and the best of them is accepted
if it leads the best of any other term by a margin; within the margin fewer
edits decide.  Names of materials and ages that are not listed are entries too,
so a value close to one of them is not pulled to the list.

The index has as many entries as the list and its alias tables, whatever the
data.  Values are deduplicated per Arrow batch and remembered per worker, so the
rows are read in one narrow pass without a shuffle and no value, however
frequent, meets in one task.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreweave.llm.aliases import ALIASES, QUALIFIERS, UNLISTED

#: Least cosine of an accepted candidate, and least lead over the best of another term.
THRESHOLD = 0.25
MARGIN = 0.05
MOST_TERMS = 100_000
MOST_REMEMBERED = 1 << 17

_SPACE = re.compile(r"\s+")
_EDGES = re.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N})]+$")
_TOKENS = re.compile(r"[\p{L}\p{N}][\p{L}\p{M}\p{N}'’.\-]*")


def normalise(value: str) -> str:
    """Lower case without accents, doubled blanks and marks at the ends."""
    text = unicodedata.normalize("NFKD", value)
    text = "".join(c for c in text if not unicodedata.combining(c)).lower()
    return _EDGES.sub("", _SPACE.sub(" ", text).strip())


def grams(text: str) -> set[str]:
    """Letters, bigrams in either order, and pairs one letter apart, of the text between end marks.

    A typing error spoils few of them: a swap leaves the unordered bigram, a
    wrong letter the pair around it.
    """
    s = f"^{text}$"
    out = set(text)
    for a, b in zip(s, s[1:]):
        out.update((a + b, f"~{min(a, b)}{max(a, b)}"))
    out.update(f"{a}_{b}" for a, b in zip(s, s[2:]))
    return out


def edit_distance(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours; most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        before, row = row, new
        if min(row) > most:
            return most + 1
    return row[-1]


def allowed_edits(length: int, listed: bool = True) -> int:
    """Edits within which a written name still counts as the entry; one less for another name of some length."""
    most = 0 if length < 4 else 1 if length < 5 else 2 if length < 8 else 3
    return most if listed or most < 2 else most - 1


class Index:
    """Inverted n-gram index of one kind of terms: entries are (name, term_id), 0 for unlisted names."""

    def __init__(self, terms: list[tuple[int, str, str | None]], aliases: dict[str, list[str]], unlisted: str = ""):
        names: dict[str, int] = {}
        self.remembered: dict[str, tuple[int, float]] = {}
        self.codes: dict[str, int] = {}
        for term_id, term, code in terms:
            names.setdefault(normalise(term), term_id)
            if code:
                self.codes.setdefault(normalise(code), term_id)
        self.listed = frozenset(names)
        for term_id, term, _ in terms:
            for a in aliases.get(normalise(term), []):
                names.setdefault(normalise(a), term_id)
        for u in unlisted.split(","):
            if u.strip():
                names.setdefault(normalise(u), 0)
        self.names = names
        self.most_words = max((n.count(" ") + 1 for n in names), default=1)
        self.entries = sorted(names.items())
        postings: dict[str, list[int]] = defaultdict(list)
        for k, (name, _) in enumerate(self.entries):
            for g in grams(name):
                postings[g].append(k)
        n = len(self.entries)
        self.weight = {g: math.log(1 + n / len(p)) for g, p in postings.items()}
        self.unseen = math.log(1 + n)
        self.postings = dict(postings)
        self.norm = [math.sqrt(sum(self.weight[g] ** 2 for g in grams(name))) for name, _ in self.entries]

    def candidates(self, text: str) -> list[tuple[float, str, int]]:
        """(cosine, name, term_id) of the entries that share an n-gram, best first, ties by name."""
        dots: dict[int, float] = defaultdict(float)
        square = 0.0
        for g in grams(text):
            w = self.weight.get(g, self.unseen)
            square += w * w
            for k in self.postings.get(g, ()):
                dots[k] += w * w
        norm = math.sqrt(square)
        scored = [(d / (norm * self.norm[k]), *self.entries[k]) for k, d in dots.items()]
        return sorted(scored, key=lambda x: (-x[0], x[1]))

    def lookup(self, text: str) -> int | None:
        """Term of a name or code written exactly so, 0 for an unlisted name, None if unknown."""
        if text in self.names:
            return self.names[text]
        return self.codes.get(text)

    def nearest(self, text: str, threshold: float = THRESHOLD, margin: float = MARGIN) -> tuple[int, float] | None:
        """(term_id, score) of the accepted candidate; None if none is accepted."""
        best: dict[int, tuple[float, int]] = {}
        for score, name, term in self.candidates(text):
            if score < threshold:
                break
            if term in best and best[term][0] - score >= margin:
                continue
            most = allowed_edits(min(len(name), len(text)), name in self.listed)
            d = edit_distance(text, name, most)
            if d <= most and (term not in best or d < best[term][1]):
                best[term] = (max(score, best.get(term, (0.0, 0))[0]), d)
        if not best:
            return None
        lead = max(x for x, _ in best.values())
        close = sorted((d, -x, t) for t, (x, d) in best.items() if lead - x < margin)
        if len(close) > 1 and close[0][0] == close[1][0]:
            return None
        return close[0][2], -close[0][1]

    def term_of(self, value: str) -> tuple[int, float]:
        """(term_id, confidence) that a value means; (0, confidence) if it names nothing listed.

        Answers are remembered as long as the worker lives, for MOST_REMEMBERED values at a time.
        """
        found = self.remembered.get(value)
        if found is None:
            if len(self.remembered) >= MOST_REMEMBERED:
                self.remembered.clear()
            found = self.remembered[value] = self._meaning(value)
        return found

    def __getstate__(self) -> dict:
        return self.__dict__ | {"remembered": {}}

    def _meaning(self, value: str) -> tuple[int, float]:
        text = normalise(value)
        if not text:
            return 0, 0.0
        exact = self.lookup(text)
        if exact is not None:
            return exact, 1.0
        if text.endswith("erz") and self.lookup(text[:-3]) is not None:  # a compound with "ore"
            return self.lookup(text[:-3]), 0.95
        tokens = [t.strip(".'’-") for t in _TOKENS.findall(text)]
        tokens = [re.sub("^mid-(?=.)", "", t) for t in tokens if t]
        rest = [t for t in tokens if t not in QUALIFIERS]
        # a name with words around it, longest first
        for n in range(min(self.most_words, len(tokens)), 0, -1):
            hits = {self.lookup(" ".join(tokens[i : i + n])) for i in range(len(tokens) - n + 1)} - {None}
            named = [i for i in range(len(tokens) - n + 1) if self.lookup(" ".join(tokens[i : i + n])) is not None]
            others = [t for k, t in enumerate(tokens) if not any(i <= k < i + n for i in named) and t not in QUALIFIERS]
            if len(hits) == 1 and (not others or n > 1 or max(len(tokens[i]) for i in named) > 3):
                return hits.pop(), 0.95
            if len(hits - {0}) == 1 and len(hits) > 1 and not others:
                return (hits - {0}).pop(), 0.9
        for body in dict.fromkeys((text, " ".join(rest), text.replace(" ", ""))):
            if body:
                near = self.nearest(body)
                if near is not None:
                    return near
        if len(rest) > 1:
            found = {near for t in rest if (near := self.nearest(t))}
            terms = {t for t, _ in found}
            if len(terms) == 1 and len(rest) - sum(self.nearest(t) is not None for t in rest) == 0:
                return max(found, key=lambda x: x[1])
        return 0, 0.0


def build_indexes(canon: DataFrame, aliases: dict = ALIASES, unlisted: dict = UNLISTED) -> dict[str, Index]:
    """One index per kind of canon_terms (term_id, kind, term, code), a list of at most MOST_TERMS rows."""
    rows = canon.select("term_id", "kind", "term", "code").where("term is not null").limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"the canonical list has more than {MOST_TERMS} terms")
    kinds: dict[str, list] = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["term_id"]):
        kinds[r["kind"]].append((r["term_id"], r["term"], r["code"]))
    return {k: Index(v, aliases.get(k, {}), unlisted.get(k, "")) for k, v in kinds.items()}


def map_values(values: DataFrame, canon: DataFrame, kind: str = "kind", value: str = "value") -> DataFrame:
    """``values`` with ``term_id`` (0: nothing listed) and ``confidence``.

    ``kind`` names the part of the list.  Null and blank values get 0, unknown
    kinds too.  Rows are kept as they are, repeated ones too; a column of the
    name term_id or confidence in ``values`` is replaced.
    """
    shipped = values.sparkSession.sparkContext.broadcast(build_indexes(canon))
    values = values.drop("term_id", "confidence")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        indexes = shipped.value

        def one(k: str, v: str) -> tuple[int, float]:
            return indexes[k].term_of(v) if k in indexes else (0, 0.0)

        for b in batches:
            found = [one(k, v) if isinstance(v, str) and isinstance(k, str) else (0, 0.0) for k, v in zip(b[kind], b[value])]
            yield b.assign(
                term_id=pd.Series([t for t, _ in found], dtype="int32", index=b.index),
                confidence=pd.Series([c for _, c in found], dtype="float64", index=b.index),
            )

    schema = T.StructType(
        [*values.schema.fields, T.StructField("term_id", T.IntegerType()), T.StructField("confidence", T.DoubleType())]
    )
    return values.mapInPandas(look, schema)


def written_values(observations: DataFrame, reports: DataFrame, canon: DataFrame) -> DataFrame:
    """(record_key, field, pos, kind, value): non-blank values that are not themselves a term of their kind.

    Commodities of a record_id that is extracted again count once: the earliest
    extraction, then the smallest array, stands for it.
    """
    rows = []
    for f in ("lithology", "geologic_age"):
        rows.append(
            observations.select(
                F.col("obs_id").alias("record_key"), F.lit(f).alias("field"), F.lit(1).alias("pos"), F.lit(f).alias("kind"), F.col(f).alias("value")
            )
        )
    once = reports.groupBy("record_id").agg(F.min_by("commodities", F.struct(F.coalesce("extracted_at", F.lit("9999-12-31").cast("timestamp")), "commodities")).alias("commodities"))
    rows.append(
        once.select(F.col("record_id").alias("record_key"), F.posexplode("commodities").alias("pos0", "value")).select(
            "record_key", F.lit("commodities").alias("field"), (F.col("pos0") + 1).cast("int").alias("pos"), F.lit("commodity").alias("kind"), "value"
        )
    )
    every = rows[0].unionByName(rows[1]).unionByName(rows[2]).where(F.regexp_replace("value", r"(?U)\s+", "") != "")
    # the list is small and fixed; its size is checked where the index is built
    terms = canon.select("kind", F.col("term").alias("value")).distinct()
    return every.join(terms, ["kind", "value"], "left_anti").select("record_key", "field", "pos", "kind", "value")


def unmatched_report(mapped: DataFrame, kind: str = "kind", value: str = "value") -> DataFrame:
    """(kind, value, n): the distinct values without an entry and how often they occur."""
    return mapped.where(F.col("term_id") == 0).groupBy(kind, value).agg(F.count("*").alias("n"))
