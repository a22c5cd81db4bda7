import random
from difflib import SequenceMatcher

from oreweave.operators.fusion import group_signs, name_candidates


def kept(keys, r):
    out = [dict() for _ in keys]
    for at, bits, signs, budget in group_signs(keys, r):
        for j, i in enumerate(at):
            out[i].update({int(s): (int(bits[j]) >> 6, budget) for s in signs[:, j]})
    return out


def test_similar_keys_share_a_sign_and_their_letter_bits():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcde0") for _ in range(rng.randint(1, 30))) for _ in range(150)]
    twist = []
    for b in base:
        x = list(b)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(x) + 1)
            x[i : i + rng.randint(0, 1)] = [rng.choice("abcdef")] * rng.randint(0, 1)
        twist.append("".join(x) or "a")
    left, right = kept(base, 0.88), kept(twist, 0.88)
    mask = (1 << 58) - 1
    met = {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if any(((a[s][0] ^ b[s][0]) & mask).bit_count() <= b[s][1] for s in a.keys() & b.keys())}
    alike = {(i, j) for i, a in enumerate(base) for j, b in enumerate(twist) if SequenceMatcher(None, a, b).ratio() >= 0.88}
    assert len(alike) > 50 and alike <= met and len(met) < 0.2 * len(base) * len(twist)


def test_signs_are_never_broadcast(spark):
    frame = lambda names: spark.createDataFrame([(i, n, None, None) for i, n in enumerate(names)], "_ord long, site_name string, latitude double, longitude double")
    found = name_candidates(frame(["Red Mountain Mine", "Blue Lode", "x" * 80]), frame(["Red Mountains Mine", "Green Pit", "x" * 81]), 88.0)
    assert {tuple(r) for r in found.collect()} == {(0, 0), (2, 2)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [key#" in plan and "BroadcastHashJoin [key#" not in plan and "BroadcastHashJoin [sign#" not in plan
