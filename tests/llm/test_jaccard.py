import random
from collections import Counter, defaultdict

import pytest

from chronolake.llm import jaccard

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_force(texts):
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    held = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in held[g])
        for g in sets[i]:
            held[g].append(i)
        for j, k in shared.items():
            if 100 * k >= 80 * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def groups(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(df).collect()}


def test_documents_against_brute_force(docs, texts):
    assert groups(docs) == brute_force(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_around_the_threshold(spark, seed):
    """Chains, hot groups of near copies and a shared passage, with few to many words."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passage = " ".join(word() for _ in range(60))
    out = {}
    for base in range(12):
        words = [word() for _ in range(rng.choice([3, 6, 9, 14, 30, 80, 200]))]
        for _ in range(rng.choice([1, 3, 40])):
            own = list(words)
            for _edit in range(rng.randrange(0, max(2, len(words) // 12))):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own += [word() for _ in range(rng.randrange(0, 3))]
            out[len(out)] = " ".join(own) + (" " + passage if base % 4 == 0 else "")
    df = spark.createDataFrame(list(out.items()), "doc_id long, text string").repartition(5)
    assert groups(df) == brute_force(out)


def test_large_buckets_are_compared_whole(spark, monkeypatch):
    """A group larger than a block whose members reach each other only in a chain."""
    rng = random.Random(5)
    words = [f"v{k}" for k in range(60)]
    out = {}
    for k in range(120):
        words[rng.randrange(60)] = f"n{k}"
        out[k] = " ".join(words)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    df = spark.createDataFrame(list(out.items()), "doc_id long, text string")
    assert groups(df) == brute_force(out)


def test_odd_rows(odd_rows, no_rows):
    rows = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_groups(odd_rows).collect())
    assert rows[:7] == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 4, 5), (6, 4, 5), (6, 4, 5)]
    assert len(rows) == 9
    assert jaccard.jaccard_groups(no_rows).count() == 0


def test_parity_never_exceeds_the_difference():
    import numpy as np

    rng = np.random.default_rng(0)
    for n, m in ((5, 7), (100, 160), (900, 1000)):
        a, b = rng.integers(0, 1 << 63, n).astype(np.uint64), rng.integers(0, 1 << 63, m).astype(np.uint64)
        b[: n // 2] = a[: n // 2]
        doc = np.repeat([0, 1], [n, m])
        bits = jaccard.parity(doc, np.concatenate([a, b]), 2).to_pylist()
        assert jaccard.differ(*bits) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_unrelated_short_sets_share_no_bucket():
    """Sets with many empty parts are told apart by other partitions, and linked ones still meet."""
    import numpy as np

    rng = np.random.default_rng(1)
    low, high = jaccard.bands()
    for size in (4, 5, 7, 8, 9, 15, 16):
        n = 20_000
        s = np.sort(rng.integers(0, 1 << 63, (n, size)).astype(np.uint64) * np.uint64(2), axis=1)
        near = s.copy()
        near[:, size // 2] = rng.integers(0, 1 << 63, n).astype(np.uint64)
        near = np.sort(near, axis=1)
        both = np.concatenate([s, near]).ravel()
        sig, owner = jaccard.signatures(np.repeat(np.arange(2 * n), size), both, 2 * n, low, high)
        held = defaultdict(set)
        for g, o in zip(sig.tolist(), owner.tolist()):
            held[g].add(o)
        assert max(len({o % n for o in own}) for own in held.values()) <= 3, size
        if 100 * (size - 1) >= 80 * (size + 1):
            meets = {o % n for own in held.values() for o in own if (o + n) % (2 * n) in own}
            assert len(meets) == n, size


def test_signatures_common_in_a_task(spark, monkeypatch):
    """Hot signatures give stars in the tasks; the groups are the same."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(90)]
    out = {}
    for k in range(260):
        words = list(base) if k % 4 else [f"u{k}x{j}" for j in range(90)]
        for _ in range(rng.randrange(0, 9)):
            words[rng.randrange(90)] = f"n{rng.randrange(10**6)}"
        out[k] = " ".join(words)
    monkeypatch.setattr(jaccard, "HOT", 5)
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    df = spark.createDataFrame(list(out.items()), "doc_id long, text string").repartition(3)
    assert groups(df) == brute_force(out)
