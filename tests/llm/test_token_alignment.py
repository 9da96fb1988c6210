import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordforge.llm import token_alignment as ta

ALPHABET = [*"abAZ09 \t\n.,'!-_<|>éÉßİσ中文́  ​\x0b\x85\x1c\x1f😀¼ªŸẞ▁", "  ", " the", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>", "'s", "'LL", "don't", "ing ", " \n", "\n\n", "***"]


def plain(texts):
    """What each text gives, from whole-text encodings, by definition."""
    a_tok = Tokenizer.from_file(public_tokenizers.path(ta.A_FILE))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(ta.B_FILE))
    byte_of = ta.byte_level()
    out, held = [], Counter()
    for text in texts:
        if not text:
            out.append(None)
            continue
        enc = a_tok.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
        ids = b_tok.encode(text)
        b = [(i, bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()) for i in ids]
        want = (" " + text).encode()
        if b"".join(t for _, t in a) != want or b"".join(t for _, t in b) != want:
            out.append(None)
            continue
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, t in side:
                own.append((i, at, at + len(t)))
                at += len(t)
            spans.append(own)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        group_of = lambda e: bisect_left(cuts, e)
        sides = [[[] for _ in cuts] for _ in spans]
        for side, own in zip(spans, sides):
            for i, _, e in side:
                own[group_of(e)].append(str(i))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides)]
        by_byte = [[i for i, s, e in side for _ in range(s, e)] for side in spans]  # which token each byte is in, and where that begins
        begins = [[s for _, s, e in side for _ in range(s, e)] for side in spans]
        links = [(i, j) for i, _, j, _ in dict.fromkeys(zip(by_byte[0], begins[0], by_byte[1], begins[1]))]
        held.update(set(links))
        out.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    rows = []
    for x in out:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            links = x[3]
            rows.append((*x[:3], len(links), sum(held[k] == most[k[0]] for k in links), sum(held[k] for k in links), x[4]))
    return rows


def got(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in df.collect()}


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return [None, "", " ", "  ", "\n", "a ", "▁", "x" * 3000, " the the the", *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 30))) for _ in range(n))]


def test_equals_whole_text_encoding(spark, docs):
    texts = odd_texts(1500)
    want = plain(texts)
    rows = docs([(k, t) for k, t in enumerate(texts)]).repartition(5)
    for hot in (ta.HOT_PAIRS, 20, 0):  # the broadcast and the shuffled part give the same sums
        assert got(ta.align_tokens(rows, hot_pairs=hot)) == dict(enumerate(want))


def test_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = rows.select("doc_id", "text").orderBy("doc_id").collect()
    assert got(ta.align_tokens(rows)) == dict(zip([r[0] for r in texts], plain([r[1] for r in texts])))


def test_small_store_forgets_and_gives_the_same(monkeypatch):
    import pyarrow as pa

    texts = pa.array([t for t in odd_texts(300) if t], pa.string())
    whole = ta.Aligner()
    monkeypatch.setattr(ta, "STORED_CHUNKS", 40)
    small = ta.Aligner()
    small.store = ta.Store()
    for lo in (0, 100, 50, 0, 200):
        part = texts.slice(lo, 60)
        for x, y in zip(whole.documents(part), small.documents(part)):
            assert all((np.asarray(p) == np.asarray(q)).all() for p, q in zip(x, y))


def test_shared_cuts_equal_the_intersection():
    rng = np.random.default_rng(5)
    for n in [*range(1, 60), 3000]:
        for share in (0.02, 0.3, 0.9):
            a, b = (np.unique(np.append(rng.integers(1, max(2, int(n / share)), n), 10**6)) for _ in range(2))
            assert ta.shared_cuts(a, b).tolist() == np.intersect1d(a, b).tolist()
    assert ta.shared_cuts(np.arange(1, 10**6, 2), np.append(np.arange(2, 10**6 - 2, 2), 10**6 - 1)).tolist() == [10**6 - 1]  # no common end but the last


def test_repeats_nulls_and_clashing_columns(spark):
    rows = spark.createDataFrame([(None, "same text"), (None, "same text"), (7, "same text"), (7, None), (8, "other")], "doc_id bigint, text string")
    rows = rows.withColumn("codes", F.lit(1)).withColumn("_row", F.lit(1)).withColumn("n_a", F.lit("x"))
    out = ta.align_tokens(rows).select("doc_id", "n_links", "n_best", "count_sum").collect()
    same = [tuple(r)[1:] for r in out if r["doc_id"] is None]
    assert len(out) == 5 and len(same) == 2 and same[0] == same[1]
    assert same[0][1] == same[0][0] and same[0][2] == 3 * same[0][0]  # three documents hold each of its pairs
    assert sorted(r["n_links"] == 0 for r in out) == [False, False, False, False, True]


def test_empty_table_and_a_long_text(spark, docs):
    assert ta.align_tokens(docs([])).collect() == []
    text = "word " * 60_000 + "x" * 20_000
    assert got(ta.align_tokens(docs([(1, text)])))[1][:2] == tuple(len(x) for x in whole_ids(text))


def whole_ids(text):
    a = Tokenizer.from_file(public_tokenizers.path(ta.A_FILE)).encode(" " + text, add_special_tokens=False).ids
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(ta.B_FILE)).encode(text)
