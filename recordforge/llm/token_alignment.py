"""Alignment of two tokenizers' tokens over the same bytes (operator 12).

Both tokenizers read a blank and the text. A byte offset where a token of each
ends is a shared cut; between neighbouring cuts lies one group of A and B tokens.
Cuts are found by divide and conquer: in an interval a common end near its middle
is located by bisecting B's ends for A's, the interval is split there, and both
halves are treated alike; an interval without a common end is a leaf, one group.
All intervals of a level are treated together, in arrays.

No token of either crosses from a character that is no white space into a blank
(``tests/llm/test_token_alignment.py`` holds that against whole texts), so the
chunks between such places have tokens of their own: the distinct chunks of a
batch are encoded and aligned once and their results gathered. The store of
chunks in a worker is bounded.

A link is an occurrence of an A and a B token that overlap. How many documents
hold an id pair linked is counted by Spark over the whole corpus; documents then
meet the counts of their pairs. The ``HOT_PAIRS`` commonest pairs, which make up
nearly all links and would be hot keys, are broadcast (at most so many rows of
three numbers); the links of all other pairs are joined by shuffle.

Null and empty texts, and texts whose tokens' bytes are not those of the blank
and the text (U+2581 reads as a blank), have no tokens: zeros and an empty digest.
Repeated rows, equal ids and null ids are rows of their own, each a document of
the counts. A long text is cut into chunks like any other; a chunk of any length
is encoded whole. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import by_value, map_batches, materialise, text_slices
from .tokens import worker_store

by_value(__name__)

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Id pairs whose counts are broadcast: the commonest. All others are joined by shuffle.
HOT_PAIRS = 1 << 17
#: Text of a slice, of an encoded string of chunks, and chunks at hand in a worker.
SLICE_BYTES, STRING_BYTES, STORED_CHUNKS = 4_000_000, 600, 300_000
#: Places near the middle that are tried before an interval is searched as a whole.
NEAR = (0, 1, -1, -2)

#: Before a blank that follows no white space and stands before some other character at last.
_CUT = re.compile(r"(?<=\S)(?= +[^ ])")
#: Texts in which not every blank is such a place (RE2).
_UNEVEN = r"[\x09-\x0d\x1c-\x20\x{85}\p{Z}] |^ | $"
#: Characters whose classes are the same in every version of Unicode.
_PLAIN = re.compile("[\\t\\n -~\xa1-\u024f]*")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links")


def shared_cuts(ends_a, ends_b):
    """The values that the ascending arrays ``ends_a`` and ``ends_b`` (byte offsets; equal last values) have in common."""
    import numpy as np

    if not len(ends_a):
        return ends_a[:0]
    found = [ends_a[-1:]]
    lo, hi = np.array([0]), np.array([len(ends_a) - 1])  # A's ends lo..hi-1 lie inside the interval, hi is its own end
    while True:
        inside = hi > lo
        if not inside.any():
            break
        lo, hi = lo[inside], hi[inside]
        middle = (lo + hi) // 2
        cut = np.full(len(lo), -1)
        for step in NEAR:
            at = middle + step
            tried = np.nonzero((cut < 0) & (at >= lo) & (at < hi))[0]
            value = ends_a[at[tried]]
            meets = ends_b[np.searchsorted(ends_b, value)] == value
            cut[tried[meets]] = at[tried[meets]]
        for k in np.nonzero((cut < 0) & (hi - lo > len(NEAR)))[0].tolist():  # no common end near the middle: the nearest of all
            inner = ends_a[lo[k] : hi[k]]
            meets = np.nonzero(ends_b[np.searchsorted(ends_b, inner)] == inner)[0]
            if len(meets):
                cut[k] = lo[k] + meets[np.argmin(np.abs(meets + lo[k] - middle[k]))]
        split = cut >= 0
        lo, hi, cut = lo[split], hi[split], cut[split]
        found.append(ends_a[cut])
        lo, hi = np.concatenate([lo, cut + 1]), np.concatenate([cut, hi])
    return np.sort(np.concatenate(found))


def overlaps(ends_a, ends_b):
    """(i, j) of all tokens of A and B, given by their ends, whose byte ranges overlap."""
    import numpy as np

    starts = np.concatenate([[0], ends_a[:-1]])
    first = np.searchsorted(ends_b, starts, side="right")
    n = np.searchsorted(ends_b, ends_a, side="left") - first + 1
    i = np.repeat(np.arange(len(ends_a)), n)
    return i, first[i] + np.arange(len(i)) - (np.cumsum(n) - n)[i]


def byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Chunks of text (each begins with a blank) -> their tokens, groups and links."""

    def __init__(self, a_path: str | None = None, b_path: str | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import numpy as np
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        a_path, b_path = a_path or public_tokenizers.path(A_FILE), b_path or public_tokenizers.path(B_FILE)
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.bytes_a = [b""] * self.a.get_vocab_size()
        byte_of = byte_level()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = entry.encode() if entry in special else bytes(map(byte_of.__getitem__, entry))
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if is_byte else p.replace("▁", " ").encode() for p, is_byte in pieces]
        self.size_a, self.size_b = (np.fromiter(map(len, t), dtype=np.int64) for t in (self.bytes_a, self.bytes_b))
        self.fast_a = self._ranked({t: i for i, t in enumerate(self.bytes_a) if self.a.id_to_token(i) not in special})
        # each id with the mark that follows it: inside a group, at the end of its side
        ids = {"a": (len(self.bytes_a), "|"), "b": (len(self.bytes_b), ";")}
        self.marks = {k: np.array([[f"{i}{mark}" for i in range(n)] for mark in (",", end)], dtype=object) for k, (n, end) in ids.items()}
        self.n_codes = len(self.bytes_a) * len(self.bytes_b)
        stores = worker_store()
        self.store = stores[key] if (key := ("aligned", a_path, b_path)) in stores else stores.setdefault(key, Store())

    def _ranked(self, ranks: dict[bytes, int]):
        """A's vocabulary for tiktoken, which is some three times faster, if its merges go by their ids; else None."""
        import public_tokenizers
        import tiktoken

        probe = " The quick (brown) fox's 12,345 jumps;\n\tthey'LL über-ñandú!!  ***end\n\n ok"
        try:
            fast = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            same = fast.encode_ordinary(probe) == self.a.encode(probe, add_special_tokens=False).ids
        except ValueError:  # not a byte-level vocabulary
            return None
        return fast if same else None

    def _ids(self, strings: list[str]):
        """Ids of A and of B of all strings, one after the other; each string begins with a blank, which B adds by itself."""
        from itertools import chain

        import numpy as np

        if self.fast_a is not None and all(map(_PLAIN.fullmatch, strings)):
            a = map(self.fast_a.encode_ordinary, strings)
        else:
            a = [e.ids for e in self.a.encode_batch_fast(strings, add_special_tokens=False)]
        b = self.b.encode([s[1:] for s in strings], num_threads=1)
        return [np.fromiter(chain.from_iterable(x), dtype=np.int64) for x in (a, b)]

    def align(self, chunks: list[str]):
        """Of each chunk: (n_a, n_b, n_groups, n_links) as rows of an array, -1 where its tokens' bytes are not its own; digest texts; codes of all links."""
        import numpy as np

        if not chunks:
            return np.zeros((0, 4), dtype=np.int64), [], np.zeros(0, dtype=np.int64)
        raw = [c.encode() for c in chunks]
        bounds = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        whole = b"".join(raw)
        # strings of chunks are encoded faster than chunks; one that ends in white space, or in what B takes for it, ends its string
        open_end = np.fromiter((c[-1].isspace() or c[-1] == "▁" for c in chunks), dtype=bool, count=len(chunks))
        full = np.diff(bounds // STRING_BYTES, append=-1) != 0
        ends = (np.nonzero(full | open_end)[0] + 1).tolist()
        a, b = self._ids(["".join(chunks[x:y]) for x, y in zip([0, *ends], ends)])
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != whole or b"".join(map(self.bytes_b.__getitem__, b.tolist())) != whole:
            if len(chunks) == 1:
                return np.full((1, 4), -1), [""], np.zeros(0, dtype=np.int64)
            half = len(chunks) // 2
            parts = [self.align(x) for x in (chunks[:half], chunks[half:])]
            return np.concatenate([p[0] for p in parts]), parts[0][1] + parts[1][1], np.concatenate([p[2] for p in parts])

        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        cuts = shared_cuts(ends_a, ends_b)
        upto_a, upto_b = (np.searchsorted(e, cuts, side="right") for e in (ends_a, ends_b))  # tokens until each cut
        i, j = overlaps(ends_a, ends_b)
        to_g = np.searchsorted(cuts, bounds, side="right")
        if not (cuts[to_g - 1] == bounds).all():
            raise ValueError("a token crosses from one chunk into the next")
        to_a, to_b = upto_a[to_g - 1], upto_b[to_g - 1]
        counts = np.diff(np.column_stack([to_a, to_b, to_g, np.searchsorted(i, to_a, side="left")]), axis=0, prepend=np.zeros((1, 4), dtype=np.int64))

        # the digest: each group's A ids, then its B ids, each id with the mark that follows it
        marks = self.marks
        group_a, group_b = np.searchsorted(cuts, ends_a, side="left"), np.searchsorted(cuts, ends_b, side="left")
        before_a, before_b = upto_b - np.diff(upto_b, prepend=0), upto_a
        text = np.empty(len(a) + len(b), dtype=object)
        last_a, last_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        last_a[upto_a - 1], last_b[upto_b - 1] = 1, 1
        text[np.arange(len(a)) + before_a[group_a]] = marks["a"][last_a, a]
        text[np.arange(len(b)) + before_b[group_b]] = marks["b"][last_b, b]
        text, to = text.tolist(), (to_a + to_b).tolist()
        digest = ["".join(text[x:y]) for x, y in zip([0, *to[:-1]], to)]
        return counts, digest, a[i] * len(self.bytes_b) + b[j]

    def known(self, chunks: list[str]):
        """Places in the store of distinct chunks (without their first blank), which are aligned if they are new."""
        import numpy as np

        held = self.store
        index = held.index
        missing = [c for c in chunks if c not in index]
        if missing and len(index) + len(missing) > STORED_CHUNKS:
            held.forget()
            index = held.index
            missing = [c for c in chunks if c not in index]
        for lo in range(0, len(missing), 20_000):
            part = missing[lo : lo + 20_000]
            held.add(part, *self.align([" " + c for c in part]))
        places = np.fromiter(map(index.__getitem__, chunks), dtype=np.int64, count=len(chunks))
        held.uses[places] += 1
        return places

    def documents(self, texts):
        """Of an Arrow array of texts: COLUMNS as arrays, digests, and the documents' distinct links (offsets, codes, times)."""
        import hashlib

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts.cast(pa.string()), "")
        n_docs = len(texts)
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False) & filled
        even = np.nonzero(filled & ~uneven)[0]
        uneven = np.nonzero(uneven)[0]
        # chunks without their first blank, by document
        lists = pc.split_pattern(texts.take(pa.array(even)), " ")
        words, size = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        other = [[c[1:] for c in _CUT.split(" " + t)] for t in texts.take(pa.array(uneven)).to_pylist()]
        coded = pa.concat_arrays([words, pa.array([c for x in other for c in x], pa.string())]).dictionary_encode()
        doc = np.repeat(np.concatenate([even, uneven]), np.concatenate([size, [len(x) for x in other]]).astype(np.int64))
        at = coded.indices.to_numpy().astype(np.int64)

        places = self.known(coded.dictionary.to_pylist())
        store = self.store
        counts = store.counts[places]
        lost = np.zeros(n_docs, dtype=bool)
        lost[doc[counts[at, 0] < 0]] = True
        stays = ~lost[doc]
        doc, at = doc[stays], at[stays]
        sums = [np.bincount(doc, weights=counts[at, c], minlength=n_docs).astype(np.int64) for c in range(4)]

        digest = [""] * n_docs
        line = [store.digests[p] for p in places.tolist()]
        starts = np.nonzero(np.diff(doc, prepend=-1))[0]  # a document's chunks stand together
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(doc)]):
            digest[doc[lo]] = hashlib.sha256("".join(map(line.__getitem__, at[lo:hi].tolist()))[:-1].encode()).hexdigest()

        n_chunks = max(1, len(places))
        held, times = np.unique(doc * n_chunks + at, return_counts=True)  # distinct chunks of each document
        of_doc, of_place = held // n_chunks, places[held % n_chunks]
        n = store.counts[of_place, 3]
        codes = store.codes[np.repeat(store.begin[of_place] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        of_doc, times = np.repeat(of_doc, n), np.repeat(times, n)
        order = np.argsort(of_doc * self.n_codes + codes, kind="stable")
        of_doc, codes, times = of_doc[order], codes[order], times[order]
        new = np.ones(len(codes), dtype=bool)
        new[1:] = (np.diff(codes) != 0) | (np.diff(of_doc) != 0)
        first = np.nonzero(new)[0]
        times = np.add.reduceat(times, first) if len(first) else times
        offsets = np.searchsorted(of_doc[first], np.arange(n_docs + 1))
        return sums, digest, offsets, codes[first], times


class Store:
    """Aligned chunks: their places, counts, digest texts and link codes. One that is full forgets those used once."""

    def __init__(self):
        import numpy as np

        self.index: dict[str, int] = {}
        self.digests: list[str] = []
        self.counts = np.zeros((0, 4), dtype=np.int64)
        self.begin, self.codes, self.uses = (np.zeros(0, dtype=np.int64) for _ in range(3))

    def add(self, chunks: list[str], counts, digests: list[str], codes) -> None:
        import numpy as np

        n = np.maximum(counts[:, 3], 0)
        self.index.update(zip(chunks, range(len(self.digests), len(self.digests) + len(chunks))))
        self.digests += digests
        self.begin = np.concatenate([self.begin, len(self.codes) + np.cumsum(n) - n])
        self.codes = np.concatenate([self.codes, codes])
        self.counts = np.concatenate([self.counts, counts])
        self.uses = np.concatenate([self.uses, np.zeros(len(chunks), dtype=np.int64)])

    def forget(self) -> None:
        import numpy as np

        stays = self.uses > 1
        if stays.sum() > STORED_CHUNKS // 2:
            stays = np.zeros(len(stays), dtype=bool)
        chunks = [c for c, k in zip(self.index, stays.tolist()) if k]  # the index is in the order of places
        digests = [d for d, k in zip(self.digests, stays.tolist()) if k]
        counts, uses = self.counts[stays], self.uses[stays] // 2
        n = np.maximum(counts[:, 3], 0)
        codes = self.codes[np.repeat(self.begin[stays] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        self.__init__()
        self.add(chunks, counts, digests, codes)
        self.uses = uses


def token_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document: doc_id, COLUMNS, groups_sha256 and its distinct links, ``links`` of (code, times)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def task(batches):
        import pyarrow as pa

        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(a_path, b_path)
            for at, n in text_slices(batch, "text", SLICE_BYTES):
                part = batch.slice(at, n)
                sums, digest, offsets, codes, times = aligner.documents(part.column(1))
                offsets = pa.array(offsets, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(s, pa.int64()) for s in sums), pa.array(digest, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(codes, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))],
                    ["doc_id", *COLUMNS, "groups_sha256", "codes", "times"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in COLUMNS)
    return map_batches(rows, task, f"doc_id {kind}, {numbers}, groups_sha256 string, codes array<long>, times array<long>")


def count_pairs(links: DataFrame, n_b: int) -> DataFrame:
    """(code, n_docs, best) of ``links`` (a row for each document and code): documents that hold a pair, and whether none with its A id has more."""
    counts = links.groupBy("code").agg(F.count(F.lit(1)).alias("n_docs"))
    of_a = Window.partitionBy(F.expr(f"code div {n_b}"))  # at most n_b rows
    return counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_a))


def align_tokens(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a_path: str | None = None, b_path: str | None = None, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; one row per row of ``docs``.

    Runs jobs while it is built: documents are encoded once, into the checkpoint folder."""
    import public_tokenizers
    import sentencepiece

    spark = docs.sparkSession
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path(B_FILE)).get_piece_size()
    path = scratch_path(spark, "alignment")
    digests = token_digests(docs, doc_id, text, a_path, b_path).withColumn("_row", F.monotonically_increasing_id())
    digests.write.option("compression", "zstd").parquet(path)
    held = spark.read.parquet(path)
    links = held.select("_row", F.inline(F.arrays_zip("codes", "times")).alias("code", "times"))
    pairs = materialise(count_pairs(links, n_b))
    hot = F.broadcast(materialise(pairs.orderBy(F.desc("n_docs"), "code").limit(hot_pairs)))

    def sums(met: DataFrame) -> DataFrame:
        return met.groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
            F.sum(F.col("times") * F.col("n_docs")).alias("count_sum"),
        )

    rare = links.join(hot, "code", "left_anti").join(pairs, "code")
    found = sums(links.join(hot, "code")).unionByName(sums(rare)).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return (
        held.select("_row", "doc_id", *COLUMNS, "groups_sha256")
        .join(found, "_row", "left")
        .select("doc_id", *COLUMNS, *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum")), "groups_sha256")
    )
