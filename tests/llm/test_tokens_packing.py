import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from oreweave.llm.packing import container_fill, exact_combination, pack_histogram, pack_items
from oreweave.llm.tokens import count_tokens, decode_corpus, encode_corpus, encoder, rank_file, safe_pieces, token_statistics

TEXTS = ["", None, " ", "Hello <|endoftext|> world", "中文。テスト", "a" * 300_000, "vein 12.5 g/t\n\n  end  ", "é😀‍🚜", "x y " * 80_000]


def test_encode_decode(spark):
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(TEXTS)] + [(None, "z", [1])], "doc_id long, text string, ids array<int>")
    encoded = encode_corpus(df)
    rows = {r["doc_id"]: r["ids"] for r in encoded.collect()}
    enc = encoder(rank_file())
    assert rows[0] == rows[1] == [] and rows[2] == enc.encode_ordinary(" ") and len(rows) == len(TEXTS) + 1
    assert all(rows[i] == enc.encode_ordinary(t or "") for i, t in enumerate(TEXTS))
    back = {r["doc_id"]: r["text"] for r in decode_corpus(encoded).collect()}
    assert all(back[i] == (t or "") for i, t in enumerate(TEXTS))
    counts = {r["doc_id"]: r["n_tokens"] for r in count_tokens(df).collect()}
    assert counts == {k: len(v) for k, v in rows.items()}
    assert token_statistics(encoded).agg(F.sum("n")).first()[0] == sum(map(len, rows.values()))
    assert encode_corpus(df.limit(0)).schema == encoded.schema


def test_cuts_change_no_token():
    enc, rng = encoder(rank_file()), random.Random(1)
    for _ in range(1500):
        text = "".join(rng.choice(["a", "b ", "  ", "\n", "中", "9", "'s", "'", "-", "é", "😀", " x", "ll"]) for _ in range(rng.randint(1, 60)))
        pieces = list(safe_pieces(text, 5))
        assert "".join(pieces) == text and [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_combinations_against_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        counts = np.array([0] + [rng.choice([0, 0, 1, 2]) for _ in range(12)])
        gap = rng.randint(1, 20)
        items = [n for n in range(13) for _ in range(counts[n])]
        reachable = any(
            sum(items[i] for i in c) == gap
            for k in (1, 2, 3)
            for c in combinations(range(len(items)), k)
        )
        got = exact_combination(counts, gap)
        assert (got is not None) == reachable
        if got:
            assert sum(got) == gap and all(got.count(n) <= counts[n] for n in got)


def test_histogram_patterns_use_every_item_once():
    rng = np.random.default_rng(2)
    for _ in range(50):
        counts = rng.integers(0, 5, 65)
        counts[0] = 0
        used = np.zeros(65, dtype=int)
        for pattern, again in pack_histogram(counts, 64):
            assert sum(pattern) <= 64
            for n in pattern:
                used[n] += again
        assert (used == counts).all()


def test_packing(spark):
    rng = random.Random(3)
    sizes = [(i, rng.choice([rng.randint(1, 300), 100, 2048, rng.randint(2049, 9000)])) for i in range(3000)] + [(3001, 0), (3002, None), (3003, 4096), (3003, 4096)]
    packed = pack_items(spark.createDataFrame([(a, b, 1) for a, b in sizes], "doc_id long, n_tokens int, container_id int"))
    rows = packed.collect()
    total = sum(b or 0 for _, b in sizes)
    assert sum(r["length"] for r in rows) == total and all(r["length"] > 0 for r in rows)
    whole = dict(sizes)
    assert all(r["piece"] == 0 and r["start"] == 0 for r in rows if whole[r["doc_id"]] <= 2048)
    fill = container_fill(packed).collect()
    assert max(r["used"] for r in fill) <= 2048 and {r["container_id"] for r in fill} == set(range(len(fill)))
    assert len(fill) <= -(-total // 2048) * 1.01 + 1
    assert pack_items(spark.createDataFrame([], "doc_id long, n_tokens int")).count() == 0
