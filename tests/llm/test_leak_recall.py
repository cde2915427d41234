import random
from itertools import combinations

import numpy as np

from graphloom.llm import leak


def hit(same: tuple[bool, ...], mask: str) -> bool:
    return any(all(same[at + k] for k, bit in enumerate(mask) if bit == "1") for at in range(len(same) - len(mask) + 1))


def test_every_stretch_meets_a_mask():
    for size in range(13, 26):
        most = int(size * leak.SUBSTITUTION_SHARE + 1e-9)
        for changed in (c for k in range(most + 1) for c in combinations(range(1, size - 1), k)):
            same = tuple(n not in changed for n in range(size))
            assert any(hit(same, mask) for mask in leak.FULL_MASKS), changed


def test_overlaps_with_replaced_words_equal_brute_force(spark):
    rng = random.Random(5)
    items = [[rng.choice("abcdefghijklmnopqrst") + str(rng.randrange(3)) for _ in range(rng.randrange(13, 40))] for _ in range(6)]
    docs = []
    for n in range(80):
        source = rng.choice(items)
        size = rng.randrange(13, min(30, len(source)) + 1)
        start = rng.randrange(len(source) - size + 1)
        copy = source[start : start + size]
        for at in rng.sample(range(1, size - 1), rng.randrange(int(size * 0.2) + 2)):
            copy[at] = f"other{n}x{at}"
        docs.append((n, " ".join([f"w{n}"] * rng.randrange(4) + copy + [f"v{n}"] * rng.randrange(4))))
    want = {}
    for n, text in docs:
        words = text.split()
        for k, item in enumerate(items):
            found = []
            for shift in range(-len(item) + 1, len(words)):
                low, high = max(0, -shift), min(len(item), len(words) - shift)
                found.append(leak.overlap(np.array([item[p] == words[p + shift] for p in range(low, high)]))[1:])
            length, changed = max(found, key=lambda f: (f[0], -f[1]))
            if length >= 13:
                want[n, k] = (length, changed)
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): (r["overlap_words"], r["substitutions"]) for r in leak.overlaps(d, i, masks=leak.FULL_MASKS).collect()}
    assert got == want and len(want) > 40


def test_recall_at_the_declared_tolerance(spark):
    rng = random.Random(11)
    for replaced in (3, 4):
        items, docs = [], []
        for n in range(200):
            item = [f"w{rng.randrange(5000)}" for _ in range(20)]
            copy = list(item)
            for at in rng.sample(range(1, 19), replaced):
                copy[at] = f"other{n}x{at}"
            items.append((n, " ".join(item)))
            docs.append((n, " ".join([f"v{n}"] * 5 + copy + [f"u{n}"] * 5)))
        d = spark.createDataFrame(docs, "doc_id bigint, text string")
        i = spark.createDataFrame(items, "item_id bigint, text string")
        got = {(r["doc_id"], r["item_id"], r["overlap_words"], r["substitutions"]) for r in leak.overlaps(d, i, leak.FULL_MASKS).collect()}
        assert got == {(n, n, 20, replaced) for n in range(200)}
