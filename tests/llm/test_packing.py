import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from recordforge.llm import packing
from recordforge.llm.tokens import tokenizer_path


def sequences(pieces):
    out = {}
    for p in pieces:
        out.setdefault(p.sequence_id, []).append((p.offset, p.length))
    return out


def check(pieces, capacity):
    for slots in sequences(pieces).values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_as_many_sequences_as_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 20, 64])
    lengths = [rng.randint(1, capacity if rng.random() < 0.3 else capacity // 3 + 1) for _ in range(rng.randint(1, 300))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan_best_fit(counts, capacity)
    assert {n: sum(r[2] for r in runs if r[0] == n) for n in counts} == counts
    used = {r[3] + j // r[5] for r in runs for j in range(r[2])}
    assert used == set(range(len(used)))
    # grouping equal lengths can only fill a sequence as best fit would or fuller
    assert len(used) <= best_fit_decreasing(lengths, capacity) + 1
    assert len(used) >= -(-sum(lengths) // capacity)


def test_plan_size_does_not_grow_with_the_counts():
    small = packing.plan_best_fit({n: 100 for n in range(1, 500)}, 4096)
    large = packing.plan_best_fit({n: 10**9 for n in range(1, 500)}, 4096)
    assert len(large) < 3 * len(small) + 2000


def test_documents_with_hot_length_long_null_and_repeated(docs):
    rows = [(i, "same words here") for i in range(300)] + [(1000, None), (1001, ""), (1002, "word " * 9000), (1003, "a"), (1003, "a")]
    df = docs(rows).repartition(4)
    got = packing.pack(packing.token_pieces(df), bucket_rows=32).collect()
    check(got, packing.CAPACITY)
    tok = Tokenizer.from_file(tokenizer_path(None))
    want = []
    for key, text in rows:
        ids = np.asarray([*tok.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(key, k, lo, len(ids[lo : lo + 4096]), zlib.crc32(ids[lo : lo + 4096].tobytes())) for k, lo in enumerate(range(0, len(ids), 4096))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    assert len(sequences(got)) == -(-sum(w[3] for w in want) // 4096)


def test_null_ids_and_empty_table(docs):
    got = packing.pack_documents(docs([(None, "a b"), (None, "a b")])).collect()
    assert len(got) == 2
    check(got, packing.CAPACITY)
    assert packing.pack_documents(docs([])).collect() == []


def test_other_columns_pass_through_and_wrong_lengths_raise(spark):
    df = spark.createDataFrame([("x", 3, "note"), ("y", 4, None)], "doc_id string, length bigint, sequence string")
    got = packing.pack(df, capacity=8, key=("doc_id",)).collect()
    assert {r.sequence for r in got} == {"note", None}
    with pytest.raises(ValueError):
        packing.pack(df, capacity=3, key=("doc_id",)).collect()
