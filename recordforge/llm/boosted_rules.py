"""Quality rules by gradient-boosted trees over document statistics (operator 11).

Every document is reduced to whole-number statistics of its whole text (words,
symbols, repeated lines, words in repeated three-word windows, ...), in Arrow
batches. Two fixed base rules reject first; what passes is judged by boosted trees
over ratios of the statistics. Trees are grown on histograms with logistic loss; on
the features of ``FALLING`` the score never rises (a split against that is not
taken, and values of subtrees stay within the bounds that their ancestors set). They
are flattened into arrays of complete binary trees, a row per tree, so a batch walks
all trees one level at a time.

The trees are fitted on the driver, on a bounded sample: of the ids whose labels agree on a
quality of 0 or 1, the ``SAMPLE_DOCS`` first by hash; of an id that several texts share, one of
them. A document is kept if its score reaches the threshold: 0.5, or less where
more than ``CLEAN_LOSS`` of the sample's good documents would go.

Null and empty texts have no words and fail the base rules. Without labels, or with
labels of one kind only, the base rules alone decide. Repeated rows and equal or null ids are
rows of their own. A very long text is one slice of its own. Labels of ids that no document has,
null labels and others than 0 and 1 are not used. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_batches, materialise, text_slices

by_value(__name__)

#: Labelled documents that the trees are fitted on, at most.
SAMPLE_DOCS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_ROWS, RIDGE = 80, 4, 0.15, 64, 20, 1.0
#: Share of the sample's good documents that the threshold may reject.
CLEAN_LOSS = 0.002
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct_words", "n_upper", "n_digits", "n_marks", "n_long_words", "n_line_ends")
STATISTICS = (*BASE, *MORE)
FEATURES = ("log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "words_a_line", "distinct_share", "upper_share", "digit_share", "mark_share", "long_share", "line_end_share")
#: Features in which the score never rises.
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "digit_share")

_SPACE = r"[\x09-\x0d\x20]"
_WORD = r"[^\x09-\x0d\x20]"


def _ranks(keys):
    """Each key's rank among the distinct ones, and how many there are."""
    import numpy as np

    distinct, rank = np.unique(keys, return_inverse=True)
    return rank, len(distinct)


def repeated_window_words(doc, word, n_docs: int, width: int = 3):
    """For each document, its words in windows of ``width`` words that it holds twice or more. ``doc`` ascends; ``word`` are codes."""
    import numpy as np

    n = len(word) - width + 1
    if n < 1:
        return np.zeros(n_docs, dtype=np.int64)
    key, size = _ranks(doc[:n] * (int(word.max()) + 1) + word[:n])
    for k in range(1, width):
        key, size = _ranks(key * (int(word.max()) + 1) + word[k : n + k])
    inside = doc[:n] == doc[width - 1 :]
    twice = inside & (np.bincount(key[inside], minlength=size)[key] > 1)
    covered = np.zeros(len(word), dtype=bool)
    for k in range(width):
        covered[k : n + k] |= twice
    return np.bincount(doc[covered], minlength=n_docs)


def count_statistics(texts):
    """STATISTICS of an Arrow array of texts, as int64 arrays."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    texts = pc.fill_null(texts.cast(pa.string()), "")
    n_docs = len(texts)

    def numbers(x):
        return x.to_numpy(zero_copy_only=False).astype(np.int64)

    def matches(pattern):
        return numbers(pc.count_substring_regex(texts, pattern))

    def pieces(lists, pattern=None):
        """(document, code) of the pieces, those that match, and a lookup of their strings."""
        coded = lists.flatten().dictionary_encode()
        doc = np.repeat(np.arange(n_docs), numbers(pc.list_value_length(lists)))
        at = numbers(coded.indices)
        stays = pc.match_substring_regex(coded.dictionary, pattern).to_numpy(zero_copy_only=False)[at] if len(at) else np.zeros(0, dtype=bool)
        return doc[stays], at[stays], coded.dictionary

    out = {}
    doc, word, words = pieces(pc.ascii_split_whitespace(texts), _WORD)
    out["n_words"] = np.bincount(doc, minlength=n_docs)
    out["word_chars"] = numbers(pc.utf8_length(texts)) - matches(_SPACE)
    out["n_symbols"] = matches(r"[#*$%&|<>]")
    out["n_repeat_words"] = repeated_window_words(doc, word, n_docs)
    out["n_distinct_words"] = np.bincount(np.unique(doc * max(1, len(words)) + word) // max(1, len(words)), minlength=n_docs)
    long_words = numbers(pc.greater(pc.utf8_length(words), 15))
    out["n_long_words"] = np.bincount(doc, weights=long_words[word], minlength=n_docs).astype(np.int64)
    line_doc, line, lines = pieces(pc.split_pattern(texts, "\n"), _WORD)
    out["n_lines"] = np.bincount(line_doc, minlength=n_docs)
    distinct = np.unique(line_doc * max(1, len(lines)) + line) // max(1, len(lines))
    out["n_dup_lines"] = out["n_lines"] - np.bincount(distinct, minlength=n_docs)
    closed = numbers(pc.match_substring_regex(lines, r"[.!?。！？][\"')\]»”’]*[\x09-\x0d\x20]*$"))
    out["n_line_ends"] = np.bincount(line_doc, weights=closed[line], minlength=n_docs).astype(np.int64)
    out["n_upper"], out["n_digits"], out["n_marks"] = matches(r"\p{Lu}"), matches(r"\p{Nd}"), matches(r"\p{P}")
    return [out[c].astype(np.int64) for c in STATISTICS]


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and STATISTICS, one row per row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            for at, n in text_slices(batch, "text"):
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x) for x in count_statistics(part.column(1)))], ["doc_id", *STATISTICS])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, task, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in STATISTICS))


def base_failed():
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def features(s: dict):
    """FEATURES as columns of a matrix, from arrays of STATISTICS."""
    import numpy as np

    s = {k: np.asarray(v, dtype=np.float64) for k, v in s.items()}
    words, chars, lines = (np.maximum(1, s[c]) for c in ("n_words", "word_chars", "n_lines"))
    by_name = {
        "log_words": np.log(words),
        "word_length": s["word_chars"] / words,
        "symbol_share": s["n_symbols"] / chars,
        "dup_line_share": s["n_dup_lines"] / lines,
        "repeat_share": s["n_repeat_words"] / words,
        "words_a_line": s["n_words"] / lines,
        "distinct_share": s["n_distinct_words"] / words,
        "upper_share": s["n_upper"] / chars,
        "digit_share": s["n_digits"] / chars,
        "mark_share": s["n_marks"] / chars,
        "long_share": s["n_long_words"] / words,
        "line_end_share": s["n_line_ends"] / lines,
    }
    return np.column_stack([by_name[f] for f in FEATURES])


class Trees:
    """Boosted trees as node arrays: tree t has nodes 0..2^(depth+1)-2, those of node i at 2i+1 and 2i+2."""

    def __init__(self, feature, above, value, base: float, threshold: float):
        self.feature, self.above, self.value, self.base, self.threshold = feature, above, value, base, threshold

    def parts(self) -> tuple:
        return self.feature, self.above, self.value, self.base, self.threshold

    def score(self, x):
        """The probability of good quality of each row of features."""
        import numpy as np

        n_trees, n_nodes = self.value.shape
        total = np.full(len(x), self.base)
        for lo in range(0, len(x), 4096):
            part = x[lo : lo + 4096]
            rows, trees = np.arange(len(part))[:, None], np.arange(n_trees)[None, :]
            node = np.zeros((len(part), n_trees), dtype=np.int64)
            for _ in range((n_nodes + 1).bit_length() - 2):
                right = part[rows, self.feature[trees, node]] > self.above[trees, node]
                node = 2 * node + 1 + right
            total[lo : lo + 4096] += self.value[trees, node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def _leaf(g, h, low, high):
    import numpy as np

    return np.clip(-g / (h + RIDGE), low, high)


def fit_trees(x, good, falling: tuple[int, ...] = (), trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Trees on the rows of ``x`` with labels ``good`` (0 or 1); the score never rises in the features ``falling``.

    A node that is not split sends all rows left (its threshold is infinite)."""
    import numpy as np

    n, n_features = x.shape
    good = np.asarray(good, dtype=np.float64)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(n_features)]
    binned = np.column_stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(n_features)])  # bin b: above edge b-1, up to edge b
    share = min(max(good.mean(), 1e-6), 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    n_nodes = 2 ** (depth + 1) - 1
    feature, above, value = np.zeros((trees, n_nodes), dtype=np.int64), np.full((trees, n_nodes), np.inf), np.zeros((trees, n_nodes))
    total = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - good, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        low, high = np.full(n_nodes, -np.inf), np.full(n_nodes, np.inf)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gains, places = np.full((n_features, width), 1e-9), np.zeros((n_features, width), dtype=np.int64)
            for f in range(n_features):
                key = (node - first) * BINS + binned[:, f]
                sums = [np.bincount(key, weights=w, minlength=width * BINS).reshape(width, BINS).cumsum(axis=1) for w in (g, h, np.ones(n))]
                (gl, hl, nl), (ga, ha, na) = (s[:, :-1] for s in sums), (s[:, -1:] for s in sums)
                lo, hi = low[first : first + width, None], high[first : first + width, None]
                left, right, whole = _leaf(gl, hl, lo, hi), _leaf(ga - gl, ha - hl, lo, hi), _leaf(ga, ha, lo, hi)
                gain = sum(-(a * w + 0.5 * (b + RIDGE) * w * w) for a, b, w in ((gl, hl, left), (ga - gl, ha - hl, right))) + ga * whole + 0.5 * (ha + RIDGE) * whole * whole
                allowed = (nl >= LEAST_ROWS) & (na - nl >= LEAST_ROWS) & (np.arange(BINS - 1) < len(edges[f]))
                if f in falling:
                    allowed &= right <= left
                gain = np.where(allowed, gain, -np.inf)
                best = gain.argmax(axis=1)
                found = gain[np.arange(width), best]
                gains[f], places[f] = np.where(found > 1e-9, found, -np.inf), best
            chosen = gains.argmax(axis=0)
            for k in range(width):
                at, f = first + k, int(chosen[k])
                children = (2 * at + 1, 2 * at + 2)
                for c in children:
                    low[c], high[c] = low[at], high[at]
                if not np.isfinite(gains[f, k]):
                    continue
                cut = int(places[f, k])
                feature[t, at], above[t, at] = f, edges[f][cut]
                if f in falling:  # below this node, left values stay above right ones
                    here = node == at
                    to_left = here & (binned[:, f] <= cut)
                    left, right = (_leaf(g[s].sum(), h[s].sum(), low[at], high[at]) for s in (to_left, here & ~to_left))
                    low[children[0]] = high[children[1]] = (left + right) / 2
            node = 2 * node + 1 + (x[np.arange(n), feature[t, node]] > above[t, node])
        leaves = np.arange(2**depth - 1, n_nodes)
        gs, hs = np.bincount(node, weights=g, minlength=n_nodes)[leaves], np.bincount(node, weights=h, minlength=n_nodes)[leaves]
        value[t, leaves] = rate * _leaf(gs, hs, low[leaves], high[leaves])
        total += value[t, node]
    model = Trees(feature, above, value, base, 0.5)
    clean = np.sort(model.score(x[good > 0.5]))
    model.threshold = min(0.5, float(clean[int(CLEAN_LOSS * len(clean))]))
    return model


def agreed_labels(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """(doc_id, good) of the ids whose non-null labels are all 0 or all 1."""
    given = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).cast("double").alias("q")).filter(F.col("doc_id").isNotNull() & F.col("q").isNotNull())
    one = given.groupBy("doc_id").agg(F.min("q").alias("lo"), F.max("q").alias("hi"))
    return one.filter((F.col("lo") == F.col("hi")) & F.col("lo").isin(0.0, 1.0)).select("doc_id", F.col("lo").cast("int").alias("good"))


def fit_quality(statistics: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Trees | None:
    """Trees from the labelled documents that pass the base rules; None where they are not of both kinds."""
    import numpy as np

    sample = materialise(agreed_labels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs))
    rows = statistics.filter(~base_failed()).join(F.broadcast(sample), "doc_id")  # at most sample_docs rows are broadcast
    one = rows.groupBy("doc_id", "good").agg(F.min(F.struct(*STATISTICS)).alias("s"))
    got = one.select("good", "s.*").toPandas()  # at most sample_docs rows of numbers
    got = got.sort_values([*STATISTICS, "good"])  # the fit does not depend on the order of rows
    if len(got) < 2 * LEAST_ROWS or got["good"].nunique() < 2:
        return None
    x = features({c: got[c].to_numpy() for c in STATISTICS})
    return fit_trees(x, got["good"].to_numpy(), tuple(FEATURES.index(f) for f in FALLING))


def judge(statistics: DataFrame, model: Trees | None) -> DataFrame:
    """``statistics`` with base_failed, quality (the trees' score, 0 to 1; null without a model) and kept."""
    out = statistics.withColumn("base_failed", base_failed())
    if model is None:
        return out.withColumn("quality", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    held = statistics.sparkSession.sparkContext.broadcast(model.parts())

    def task(batches):
        import numpy as np
        import pyarrow as pa

        trees = Trees(*held.value)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            p = trees.score(features({c: table[c].to_numpy() for c in STATISTICS}))
            failed = table["base_failed"].to_numpy()
            columns = [*batch.columns, pa.array(p), pa.array(~failed & (p >= trees.threshold))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "quality", "kept"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out.schema.fields)
    return map_batches(out, task, f"{kinds}, quality double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, STATISTICS, base_failed, quality, kept; one row per row of ``docs``. Runs jobs while it is built (statistics and fit)."""
    statistics = materialise(document_statistics(docs, doc_id, text))
    return judge(statistics, fit_quality(statistics, labels, sample_docs))
