import random

import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from recordforge.llm.tokens import DEFAULT_FILE, ChunkEncoder

ALPHABET = [*"abAZ09 \t\n.,'!-_<|>éÉßİΣσς中文́​  \x85\x1c\x1f😀¼²ªºµ×÷ÿŸKẞ", "<|endoftext|>", "'s", "'LL", "don't"]


def whole(texts):
    tok = Tokenizer.from_file(public_tokenizers.path(DEFAULT_FILE))
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def split(encoded):
    ids, offsets = encoded
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]


def test_chunks_equal_whole_texts():
    rng = random.Random(1)
    texts = [None, "", " ", "\n", *("".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(5000))]
    assert split(ChunkEncoder().encode(pa.array(texts, pa.string()))) == whole(texts)


def test_small_store_gives_the_same_ids():
    texts = ["one two three, four!", "Five six two", "seven eight nine ten", "one ten"] * 3
    enc = ChunkEncoder(max_words=3)
    for _ in range(2):
        assert split(enc.encode(pa.array(texts))) == whole(texts)


def test_other_tokenizer_without_word_ends():
    path = public_tokenizers.path("byte_bpe_50k.json")
    enc = ChunkEncoder(path)
    assert not enc.by_chunks
    texts = ["one  two", None, " three\n"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert split(enc.encode(pa.array(texts))) == want


def test_sliced_array():
    texts = pa.array(["skip me", "one two", None, "three"]).slice(1, 3)
    assert split(ChunkEncoder().encode(texts)) == whole(["one two", None, "three"])
    assert np.asarray(ChunkEncoder().encode(pa.array([], pa.string()))[1]).tolist() == [0]
