import random

import numpy as np
import pytest

from recordforge.llm import lsh_forest as J


def shingles(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, threshold=0.8):
    """{id: (class, links)} over rows with distinct ids."""
    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    label, links = {k: k for k, _ in sets}, dict.fromkeys((k for k, _ in sets), 0)
    pairs = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[i + 1 :]:
            if x and y and len(x & y) >= threshold * len(x | y):
                pairs.append((a, b))
                links[a] += 1
                links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {k: (label[k], links[k]) for k, _ in sets}


def corpus(rng, groups, first=0):
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(8, 120))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(100)}"
            rows.append((first + len(rows), " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("blocks", [(4096, 512), (8, 4)])
def test_equals_brute_force(docs, blocks):
    rng = random.Random(4)
    rows = corpus(rng, 60)
    hot = [f"h{rng.randrange(9000)}" for _ in range(90)]  # one large group of near copies, all different
    rows += [(1000 + i, " ".join([*hot[: 40 + i % 3], f"edit{i}", *hot[42:]])) for i in range(50)]
    rows += [(2000 + i, "An exact copy of a text with a few words") for i in range(40)]
    rows += [(3000, None), (3001, ""), (3002, "  \n "), (3003, "two words"), (3004, "Two  WORDS"), (3005, "three")]
    rows += [(3006, "long " * 30_000), (3007, " ".join(f"v{i}" for i in range(20_000)))]
    got = {r.doc_id: (r.class_id, r.n_links) for r in J.jaccard_join(docs(rows).repartition(5), trie_block=blocks[0], exact_block=blocks[1]).collect()}
    assert got == brute(rows)


def test_kept_rows_repeats_null_ids_extra_columns(docs):
    text = "one two three four five six seven"
    rows = [(5, text), (3, text), (3, text), (None, text), (7, "something else entirely here is written")]
    df = docs(rows).selectExpr("*", "1 AS node", "'x' AS key", "2 AS class_id")
    got = sorted((tuple(r) for r in J.jaccard_join(df).collect()), key=repr)
    assert got == sorted([(5, 3, 2, False), (3, 3, 2, True), (3, 3, 2, True), (None, None, 0, True), (7, 7, 0, True)], key=repr)
    assert J.jaccard_join(docs([])).collect() == []


def test_repeated_rows_in_a_group(docs):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (9, "a text of its own that is not alike")]
    got = {(r.doc_id, r.class_id, r.n_links) for r in J.jaccard_join(docs(rows)).collect()}
    assert got == {(1, 1, 2), (2, 1, 2), (9, 9, 0)}


def test_different_texts_that_share_an_id(docs):
    x, y = ([f"{c}{i}" for i in range(60)] for c in "xy")
    rows = [(5, " ".join(x)), (5, " ".join(y)), (7, " ".join([*x[:-1], "z"])), (9, " ".join([*y[:-1], "z"])), (3, " ".join([*y[:-1], "zz"]))]
    got = sorted((r.doc_id, r.class_id, r.n_links, r.kept) for r in J.jaccard_join(docs(rows)).collect())
    assert got == [(3, 3, 2, True), (5, 3, 2, False), (5, 5, 1, True), (7, 5, 1, False), (9, 3, 2, False)]


def test_prefix_reaches_the_recall():
    for recall in (0.9, 0.99, 0.9995):
        d = J.least_prefix(0.8, recall)
        assert 1 - (1 - 0.8**d) ** J.TREES >= recall
        assert d == J.DEPTH or 1 - (1 - 0.8 ** (d + 1)) ** J.TREES < recall
    with pytest.raises(ValueError):
        J.least_prefix(0.1, 0.9999)


def test_walk_unites_all_agreeing_members():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**32, (4, J.TREES * J.DEPTH), dtype=np.uint32)
    sig = np.repeat(base, 6, axis=0)
    for row in sig:
        row[rng.integers(8, len(row), 20)] = rng.integers(0, 2**32, 20, dtype=np.uint32)
    sig[:, :4] = 7  # all share the first tree's short prefix
    path = sig[:, : J.DEPTH]
    order = np.lexsort(path.T[::-1])
    sig = sig[order]
    label = J.walk_trie(sig, sig[:, : J.DEPTH], 4, 80)
    group = np.repeat(np.arange(4), 6)[order]
    for g in range(4):
        assert len(set(label[group == g])) == 1
    assert len(set(label)) == 4
