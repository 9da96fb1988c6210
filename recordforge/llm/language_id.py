"""Language identification by cross-parsing entropy (operator 2).

For each language a suffix automaton is built over a sample of its labelled
text. A text is parsed greedily: from the root, the automaton is followed as
far as the text occurs in the sample (the longest match), which ends a phrase;
the next phrase starts there. Few, long phrases mean a familiar language. The
cost of a text in a language is its number of phrases times log2 of the
sample's length (the bits to point at each match); the language of least cost
wins, ties go to the smaller language name. ``score`` is the winner's share of
2^-bits over all languages (0 to 1).

Text is read as classes of lower-cased letters; every letter of the samples is a
class of its own, and every run of other characters is one separator. Parsing a
text only descends from the root, so an automaton becomes one dense table whose
missing moves restart at the root with a flag, and a task parses all windows of
its texts in step with numpy: one gather per language and character. Where the
samples hold too many letters for that, a table has columns for its own
language's letters alone; where those are too many (Han), the moves are a sorted
list, bounded by the sample's length. A text is parsed whole, in windows of ``WINDOW``
classes, each starting a phrase.

The fit uses a bounded sample: for each language at most ``SAMPLE_DOCS``
documents, the first by the hash of their text among those allowed for
learning, each giving at most ``DOC_CLASSES`` classes, together at most
``SAMPLE_CLASSES``, of which all documents have equal shares. Nothing else of the corpus goes to the driver. The tables
that are broadcast are bounded by that and the number of languages.

Texts that are null or have no letter are ``und`` with score 0, as are all
texts if there is nothing to learn from. Ties and repeated rows get equal
results; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_value, map_batches, text_slices

by_value(__name__)

SAMPLE_DOCS = 200
DOC_CLASSES = 2_000
SAMPLE_CLASSES = 30_000
DENSE_CELLS = 6_000_000  # of a table of moves; beyond, they are a sorted list
WINDOW = 512
UNDETERMINED = "und"
SEPARATOR = 0


def held_out(doc_id):
    """Documents never learnt from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def suffix_automaton(codes) -> list[dict[int, int]]:
    """The transitions of the suffix automaton of ``codes``; state 0 is the root."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p != -1:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return moves


class Moves:
    """The moves of an automaton on ``width`` classes (the last one is padding), with restarts at the root.

    ``step`` takes states and classes to the next states, the top bit set where a phrase begins. The last
    state is the one between phrases, in which a text starts and which a class that the sample does not
    have leads to, a phrase of its own."""

    def __init__(self, moves: list[dict[int, int]], width: int, cells: int = DENSE_CELLS):
        between = len(moves)
        self.columns, self.keys, self.scale, padding = None, None, width, width - 1
        if (between + 1) * width > cells:  # one column for all letters that the sample does not have
            own = sorted(moves[0])
            self.columns = np.full(width, len(own), dtype=np.min_scalar_type(len(own) + 1))
            self.columns[own], self.columns[padding] = np.arange(len(own)), len(own) + 1
            padding, self.scale = len(own) + 1, len(own) + 2
            moves = [{int(self.columns[c]): to for c, to in out.items()} for out in moves]
        root = np.asarray([moves[0].get(c, between) for c in range(self.scale)], dtype=np.uint32) | np.uint32(1 << 31)
        self.padding = padding
        if (between + 1) * self.scale > cells:
            listed = sorted((s * self.scale + c, to) for s, out in enumerate(moves) for c, to in out.items())
            self.keys, self.table = np.asarray([k for k, _ in listed], dtype=np.int64), np.asarray([to for _, to in listed], dtype=np.uint32)
            self.root, self.begin = root, between
            return
        # uint32 by state * scale + class: next state * scale
        restart = (root & np.uint32(0x7FFFFFFF)) * np.uint32(self.scale) | np.uint32(1 << 31)
        table = np.tile(restart, (between + 1, 1))
        for s, out in enumerate(moves):
            for c, to in out.items():
                table[s, c] = to * self.scale
        table[:, padding] = np.arange(between + 1, dtype=np.uint32) * self.scale
        self.table, self.begin = table.ravel(), between * self.scale

    def parts(self) -> dict:
        return self.__dict__

    @classmethod
    def of(cls, parts: dict) -> Moves:
        self = cls.__new__(cls)
        self.__dict__.update(parts)
        return self

    def step(self, state: np.ndarray, c: np.ndarray, at: np.ndarray) -> None:
        """``state`` becomes the next states."""
        if self.keys is None:
            np.add(state, c, out=at, casting="unsafe")
            np.take(self.table, at, out=state, mode="clip")
            return
        np.multiply(state, self.scale, out=at, casting="unsafe", dtype=np.int64)
        at += c
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        to = np.where(self.keys[place] == at, self.table[place], self.root[c])
        state[:] = np.where(c == self.padding, state, to)


def letter_classes(texts: list[str]) -> np.ndarray:
    """The class of every code point: the letters of ``texts`` have their own, all others the one above."""
    found = set().union(*(t.lower() for t in texts))
    own = {c: k + 1 for k, c in enumerate(sorted(c for c in found if c.isalpha()))}
    other = len(own) + 1
    classes = np.zeros(0x110000, dtype=np.min_scalar_type(other + 1))
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            classes[cp] = own.get(low if len(low) == 1 else low[0], other)
    return classes


def to_classes(texts: list[str | None], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts' classes in one array and the n + 1 bounds of the texts in it. Every run of
    separators after a letter is one separator; a text begins with a letter and ends with a separator."""
    joined = "\n".join(["", *(t or "" for t in texts), ""])
    codes = classes[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    keep = codes != SEPARATOR
    keep[1:] |= keep[:-1].copy()
    kept = np.concatenate([[0], np.cumsum(keep)])
    bounds = np.cumsum([1, *(len(t or "") + 1 for t in texts)])
    return codes[keep], kept[bounds]


def equal_shares(sizes: np.ndarray, most: int, total: int) -> int:
    """The largest share of at most ``most`` with which ``sizes``, cut to it, sum to at most ``total``."""
    lo, hi = 0, most
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if np.minimum(sizes, mid).sum() <= total else (lo, mid - 1)
    return lo


class Model:
    """Languages in order, their moves one after another, and each sample's log2 length."""

    def __init__(self, languages: list[str], classes: np.ndarray | None, tables: list[dict], bits: list[float]):
        self.languages, self.classes, self.tables, self.bits = languages, classes, tables, bits
        self.padding = 0 if classes is None else int(classes.max()) + 1

    def parts(self) -> tuple:
        """Plain data to broadcast: executors need not have this package."""
        return self.languages, self.classes, self.tables, self.bits

    @classmethod
    def train(cls, samples: dict[str, list[str]]) -> Model:
        languages = sorted(k for k, v in samples.items() if any(c.isalpha() for t in v for c in t))
        texts = [t for k in languages for t in samples[k]]
        classes = letter_classes(texts) if texts else None
        tables, bits = [], []
        for k in languages:
            codes, bounds = to_classes(samples[k], classes)
            share = equal_shares(np.diff(bounds), DOC_CLASSES, SAMPLE_CLASSES)
            own = np.concatenate([codes[b : min(e, b + share)] for b, e in zip(bounds[:-1], bounds[1:])])
            tables.append(Moves(suffix_automaton(own.tolist()), int(classes.max()) + 2).parts())
            bits.append(float(np.log2(max(2, len(own)))))
        return cls(languages, classes, tables, bits)

    def phrases(self, texts: list[str | None], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """(phrases by text and language, classes by text)."""
        codes, begins = to_classes(texts, self.classes)
        sizes = np.diff(begins)
        lanes = -(-sizes // window)
        counts = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        if not lanes.sum():
            return counts, sizes
        owner = np.repeat(np.arange(len(texts)), lanes)
        first = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = np.repeat(begins[:-1], lanes) + first * window
        length = np.minimum(window, np.repeat(begins[1:], lanes) - start)
        padded = np.concatenate([codes, np.full(window, self.padding, dtype=codes.dtype)])
        grid = np.lib.stride_tricks.sliding_window_view(padded, window)[start]
        grid[np.arange(window) >= length[:, None]] = self.padding
        grid = np.ascontiguousarray(grid.T)
        for k, moves in enumerate(map(Moves.of, self.tables)):
            state = np.full(len(owner), moves.begin, dtype=np.uint32)
            begun = np.zeros(len(owner), dtype=np.uint32)
            at = np.empty(len(owner), dtype=np.int64)
            flag = np.empty(len(owner), dtype=np.uint32)
            for c in grid:
                moves.step(state, c if moves.columns is None else moves.columns[c], at)
                np.right_shift(state, 31, out=flag)
                begun += flag
                state &= 0x7FFFFFFF
            counts[:, k] = np.bincount(owner, weights=begun, minlength=len(texts)).astype(np.int64)
        return counts, sizes

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, bits per class) of each text."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        counts, sizes = self.phrases(texts)
        bits = counts * np.asarray(self.bits)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(texts)), best]
        share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
        some = sizes > 0
        lang = [self.languages[b] if s else UNDETERMINED for b, s in zip(best, some)]
        return lang, np.where(some, share, 0.0), np.where(some, least / np.maximum(1, sizes), 0.0)


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model from ``docs`` (doc_id, text, lang), all of which may be learnt from."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    hashed = usable.groupBy("lang", F.xxhash64("text").alias("h")).agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    chosen = hashed.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= sample_docs)
    picked = chosen.select("lang", "doc_id", "h").collect()  # at most sample_docs for each language
    if not picked:
        return Model.train({})
    ids = sorted({r["doc_id"] for r in picked if r["doc_id"] is not None})
    want = {(r["lang"], r["h"]) for r in picked}
    texts = (
        usable.filter(F.col("doc_id").isin(ids))
        .select("lang", F.xxhash64("text").alias("h"), F.substring("text", 1, 8 * DOC_CLASSES).alias("text"))
        .dropDuplicates(["lang", "h"])
        .collect()
    )
    samples: dict[str, list[str]] = {}
    for r in sorted(texts, key=lambda r: (r["lang"], r["h"])):
        if (r["lang"], r["h"]) in want:
            samples.setdefault(r["lang"], []).append(r["text"])
    return Model.train(samples)


def identify(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_char), one row per row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model.parts())

    def predict(batches):
        import pyarrow as pa

        fitted = Model(*held.value)
        for batch in batches:
            for at, n in text_slices(batch, "text", 8_000_000):
                part = batch.slice(at, n)
                lang, score, bits = fitted.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())],
                    ["doc_id", "lang_pred", "score", "bits_per_char"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, predict, f"doc_id {kind}, lang_pred string, score double, bits_per_char double")


def language_id(docs: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out and predict all of them."""
    model = fit(docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id"))))
    return identify(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not ``und``. Where ``model`` has learnt
    no language, so that every text is ``und``, those whose text has a letter."""
    held = docs.sparkSession.sparkContext.broadcast(model.parts())

    def keep(batches):
        import pyarrow as pa

        fitted = Model(*held.value)
        for batch in batches:
            for at, n in text_slices(batch, text, 8_000_000):
                part = batch.slice(at, n)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                if fitted.languages:
                    keeps = [x != UNDETERMINED for x in fitted.predict(texts)[0]]
                else:
                    keeps = [any(map(str.isalpha, t or "")) for t in texts]
                yield part.filter(pa.array(keeps, pa.bool_()))

    return map_batches(docs, keep, docs.schema)
