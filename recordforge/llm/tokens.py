"""Token ids of whole texts with a public tokenizer file (``tokenizers`` library).

The tokenizer's normaliser turns every run of white space into a blank and its
splitter drops the blanks, so no token crosses white space and the ids of a
text are the ids of its white-space-separated chunks in order. A batch's
distinct chunks are encoded once and gathered. Most are a word of Latin letters
and perhaps some marks, which the splitter separates and the normaliser
lower-cases: their ids are put together from those of the word and of the marks;
words not met before are encoded many at a time, told apart by their word-end
tokens. Other chunks are encoded as they are. The store of words is bounded (those
of late and those before them) and outlives a task. ``tests/llm/test_tokens.py`` holds the result against
whole-text encoding. A tokenizer whose tokens may cross white space encodes
texts as a whole.
"""

from __future__ import annotations

import re

from .common import by_value

by_value(__name__)

DEFAULT_FILE = "word_bpe_49k.json"
END_ID = 1
#: Text that is encoded at once.
ENCODE_BYTES = 8_000_000


def tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


#: Lines of one chunk: a word of lower-case Latin letters, then marks that the splitter keeps together
#: (no apostrophe: it has rules of its own); of other chunks nothing is captured.
_LINES = re.compile("(?:([a-z\xdf-\xf6\xf8-\xff]+)([-!\"#$%&()*+,./:;<=>?@\\[\\\\\\]^_`{|}~]*)|[^\n]*)\n")
_END_OF_WORD = "</w>"


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker."""
    import sys
    import types

    return vars(sys.modules.setdefault("_recordforge_worker", types.ModuleType("_recordforge_worker")))


class ChunkEncoder:
    """encode(texts) -> all ids in one array, and where each text's begin."""

    def __init__(self, path: str | None = None, max_words: int = 400_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(tokenizer_path(path))
        self.by_chunks = self._encode(["a  b\n c."]) == [b"".join(self._encode(["a", "b", "c."]))]
        # only a tokenizer that lower-cases and marks word ends lets words be told apart
        self.ends = {i for t, i in self.tok.get_vocab().items() if t.endswith(_END_OF_WORD)}
        self.by_words = bool(self.ends) and self._encode(["Ab,"]) == [b"".join(self._encode(["ab", ","]))]
        self.store = worker_store().setdefault(("ids", tokenizer_path(path)), {"words": {"": b""}, "older": {}, "marks": {}})
        self.words, self.marks = self.store["words"], self.store["marks"]
        self.max_words = max_words

    def _encode(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        out = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in out]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Words of letters only, encoded together: each ends with its one word-end token."""
        import numpy as np

        ids = np.asarray(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        last = np.nonzero(np.isin(ids, self.end_ids))[0] + 1
        if len(last) != len(words):
            return self._encode(words)
        raw, at = ids.tobytes(), [0, *(4 * last).tolist()]
        return [raw[a:b] for a, b in zip(at[:-1], at[1:])]

    @property
    def end_ids(self):
        import numpy as np

        if not isinstance(self.ends, np.ndarray):
            self.ends = np.asarray(sorted(self.ends), dtype="<u4")
        return self.ends

    def _chunks(self, chunks) -> list[bytes]:
        """The ids of distinct chunks, an Arrow array."""
        from operator import add

        import pyarrow as pa
        import pyarrow.compute as pc

        words, marks = self.words, self.marks
        if not len(chunks):
            return []
        found = []
        if self.by_words:  # one string for all is much cheaper than one for each
            lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chunks)], pa.int32()), chunks), "\n")
            found = _LINES.findall(f"{lines[0].as_py()}\n".lower())
        if len(found) != len(chunks):
            found = [("", "")] * len(chunks)
        own, after = zip(*found)
        missing = set(own).difference(words)
        if len(words) + len(missing) > self.max_words:  # what was met of late stays at hand
            older = dict(words)
            words.clear()
            marks.clear()
            words[""] = b""
            missing = set(own).difference(words)
            self.store["older"] = older
        older = self.store["older"]
        again = missing.intersection(older)
        words.update(zip(again, map(older.__getitem__, again)))
        missing = list(missing - again)
        for at in range(0, len(missing), 5_000):
            part = missing[at : at + 5_000]
            words.update(zip(part, self._encode_words(part)))
        missing = list(set(after).difference(marks))
        if missing:
            marks.update(zip(missing, self._encode(missing)))
        out = list(map(add, map(words.__getitem__, own), map(marks.__getitem__, after)))
        other = [i for i, w in enumerate(own) if not w]
        for at in range(0, len(other), 5_000):
            part = other[at : at + 5_000]
            for i, ids in zip(part, self._encode(chunks.take(pa.array(part, pa.int64())).to_pylist())):
                out[i] = ids
        return out

    def encode(self, texts):
        """(ids, offsets) of an Arrow array of strings: text k has ids[offsets[k]:offsets[k + 1]]."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.by_chunks:  # tokens may cross white space
            whole = self._encode(pc.fill_null(texts, "").to_pylist())
            sizes = np.cumsum([0, *(len(b) // 4 for b in whole)])
            return np.frombuffer(b"".join(whole), dtype="<u4"), sizes
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        distinct = self._chunks(coded.dictionary)
        flat = np.frombuffer(b"".join(distinct), dtype="<u4")
        size = np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct)) // 4
        begin = np.cumsum(size) - size
        at = coded.indices.to_numpy()
        each = size[at]
        upto = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(begin[at] - upto[:-1], each) + np.arange(upto[-1])]
        return ids, upto[bounds - bounds[0]]
