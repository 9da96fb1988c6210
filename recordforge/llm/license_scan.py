"""Licence scan by patience alignment (operator 3).

Text and template are sequences of words (lower-cased runs of letters and
digits). Within a range of both, the words that occur exactly once on either
side are anchors; the longest run of anchors in rising order (a longest
increasing subsequence) is kept, matches are extended from each anchor over
equal neighbours, and every gap between anchors is aligned again in the same
way, where words that were ambiguous may have become unique. Coverage is the
share of the template's words that are matched. Many licences differ in a word: a
hit must also match the words that tell its template from others of its family
(its name, version, lesser, affero, nc, nd, sa), and the text may not have another
such word within the aligned span; else the notice is of a licence not listed.

A text is read whole. Only positions of words that some template has can match,
so the alignment sees those; they are cut into regions where more words than
the template has, twice over, pass without one of its telling words. In a
region that does not align as a whole, as when a notice stands in it twice, the
template is aligned around every place of every telling word, unless the words
around that place are too few to reach the least coverage. A template whose words, counted with
repetition, do not reach the least coverage in a region cannot align to it and
is left out, which loses nothing. Each region yields for each template at most
one hit; a document's hits are those of at least ``min_coverage`` whose span no
longer or better covering hit overlaps.

One row per document and constant memory per text; tasks need no shuffle. Null
and empty texts have no hits. Ties go to the higher coverage, the longer
template, the smaller name. Repeated rows get equal results, extra columns are
ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_value, map_batches, text_slices
from .license_templates import FAMILIES, TEMPLATES

by_value(__name__)

MIN_COVERAGE = 0.8
_WORD = re.compile(r"[^\W_]+")
#: Words too common to begin a region on their own.
COMMON = {"a", "and", "any", "are", "as", "at", "be", "by", "for", "from", "if", "in", "is", "it", "no", "not", "of", "on", "one", "or", "that", "the", "this", "to", "with", "without", "you", "was"}


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def rising(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        back.append(piles[k - 1] if k else -1)
        if k == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[k], piles[k] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched (text index, template index) pairs, rising in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:  # extend over equal neighbours
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        once_a, once_b = unique(text, a0, a1), unique(template, b0, b1)
        pairs = sorted((i, once_b[w]) for w, i in once_a.items() if w in once_b)
        if not pairs:
            continue
        chain = [pairs[i] for i in rising([b for _, b in pairs])]
        found.extend(chain)
        ends = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        todo.extend((x + 1, y, z + 1, w) for (x, z), (y, w) in zip(ends[:-1], ends[1:]) if x + 1 < y and z + 1 < w)
    return sorted(found)


def unique(words: list[str], lo: int, hi: int) -> dict[str, int]:
    seen: dict[str, int] = {}
    for i in range(lo, hi):
        seen[words[i]] = -1 if words[i] in seen else i
    return {w: i for w, i in seen.items() if i >= 0}


def telling_apart(words: list[str]) -> tuple[frozenset, frozenset]:
    """(words of a template that a text must match, words that it may not have in between)."""
    own = set(words)
    must, others = set(), set()
    for family, needed, foreign in FAMILIES:
        if family <= own:
            must |= own & needed | {w for w in own if w.isdigit()}
            others |= foreign - own
    return frozenset(must), frozenset(others)


def genuine(words: list[str], pairs: list[tuple[int, int]], template: list[str], must: frozenset, others: frozenset) -> bool:
    """Whether the matched (text index, template index) ``pairs`` hold what tells the template from its family."""
    if not must <= {template[j] for _, j in pairs}:
        return False
    for (a, _), (b, j) in zip(pairs, pairs[1:]):
        between = words[a + 1 : b]
        if between and (not others.isdisjoint(between) or template[j].isdigit() and any(w.isdigit() for w in between)):
            return False
    return True


class Scanner:
    def __init__(self, templates: list[tuple[str, str]], min_coverage: float):
        self.min_coverage = min_coverage
        self.templates = [(name, words, Counter(words), set(words) - COMMON) for name, words in ((n, words_of(t)) for n, t in templates) if words]
        self.apart = [telling_apart(words) for _, words, _, _ in self.templates]
        self.telling = {w for _, _, _, t in self.templates for w in t}
        self.known = self.telling | {w for _, words, _, _ in self.templates for w in words}

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, float, int, int]]]:
        """(words, hits): the hits as (licence, coverage, first word, word after the last), in text order."""
        if not text:
            return 0, []
        words = words_of(text)
        telling = self.telling
        at = [i for i, w in enumerate(words) if w in telling]
        hits = []
        if at:
            present = {words[i] for i in at}
            for (name, template, counts, own), apart in zip(self.templates, self.apart):
                if apart[0] - COMMON <= present and len(own & present) >= self.min_coverage * len(own) - (len(template) - sum(counts[w] for w in own)):
                    hits.extend((name, *hit, len(template)) for hit in self.hits(words, [i for i in at if words[i] in own], template, counts, apart))
        hits.sort(key=lambda h: (-h[1] * h[4], -h[1], h[0], h[2]))
        kept: list[tuple[str, float, int, int]] = []
        taken: list[tuple[int, int]] = []  # apart from each other, in text order
        for name, coverage, lo, hi, _ in hits:
            k = bisect_left(taken, (lo, hi))
            if (k == 0 or taken[k - 1][1] <= lo) and (k == len(taken) or hi <= taken[k][0]):
                taken.insert(k, (lo, hi))
                kept.append((name, coverage, lo, hi))
        return len(words), sorted(kept, key=lambda h: (h[2], h[0]))

    def hits(self, words: list[str], at: list[int], template: list[str], counts: Counter, apart: tuple[frozenset, frozenset]):
        n, known = len(template), counts.keys()
        gap = 2 * n
        regions, start = [], 0  # with the bounds that their text may reach
        for i in range(1, len(at) + 1):
            if i == len(at) or at[i] - at[i - 1] > gap:
                regions.append((at[start:i], 0, len(words), True))
                start = i
        while regions:
            region, first, end, whole = regions.pop()
            held = Counter(words[i] for i in region)
            least = self.min_coverage * n
            if sum(min(c, held[w]) if w not in COMMON else c for w, c in counts.items()) < least:
                continue
            lo, hi = max(first, region[0] - n), min(end, region[-1] + n + 1)
            places = [i for i in range(lo, hi) if words[i] in known] if whole else []
            pairs = align([words[i] for i in places], template)
            if pairs and len(pairs) >= least:
                spots = [places[i] for i, _ in pairs]
                spots = densest(spots, least, gap)
                kept = [(places[i], j) for i, j in pairs if spots[0] <= places[i] <= spots[-1]]
                if len(spots) >= least and genuine(words, kept, template, *apart):
                    yield len(spots) / n, spots[0], spots[-1] + 1
                    before = [i for i in region if i < spots[0]], first, spots[0]
                    after = [i for i in region if i > spots[-1]], spots[-1] + 1, end
                    # a part that is nearly as long is not aligned as a whole again: many repeats would take a square of time
                    regions.extend((*r, 4 * len(r[0]) <= 3 * len(region)) for r in (before, after) if 0 < len(r[0]) < len(region))
                    continue
            # the template may be there more than once, or among other text: try it around each place of its telling words
            near = within_reach(words, region, first, end, counts, least)
            tried = set()
            inside: set[int] = set()  # hits word for word, which no other hit of the template can better
            for word in sorted(held):
                leads, times, spots = [j for j, w in enumerate(template) if w == word], counts[word], [i for i in region if words[i] == word]
                for k, i in enumerate(spots):
                    if i not in near or i in inside:
                        continue
                    lo = max(first, i - 2 * leads[-1] - 4, spots[k - times] + 1 if k >= times else 0)
                    hi = min(end, i + 2 * (n - leads[0]) + 4, spots[k + times] if k + times < len(spots) else len(words))
                    if (lo, hi) in tried:
                        continue
                    tried.add((lo, hi))
                    places = [x for x in range(lo, hi) if words[x] in known]
                    if not apart[0] <= (here := Counter(words[x] for x in places)).keys() or sum(min(c, here[w]) for w, c in counts.items()) < least:
                        continue
                    pairs = align([words[x] for x in places], template)
                    if len(pairs) >= least and genuine(words, [(places[x], j) for x, j in pairs], template, *apart):
                        lo, hi = places[pairs[0][0]], places[pairs[-1][0]] + 1
                        if len(pairs) == n == hi - lo:
                            inside.update(range(lo, hi))
                        yield len(pairs) / n, lo, hi


def within_reach(words: list[str], spots: list[int], first: int, end: int, counts: Counter, least: float) -> set[int]:
    """Those of the rising ``spots`` that have enough words of a template within twice its length on either side."""
    reach = 2 * counts.total() + 4
    held: Counter = Counter()
    lo = hi = first
    common = 0
    out = set()
    for i in spots:
        for x in range(hi, min(end, i + reach)):
            w = words[x]
            if w in counts:
                held[w] += 1
                common += held[w] <= counts[w]
        hi = max(hi, min(end, i + reach))
        for x in range(lo, min(hi, i - reach)):
            w = words[x]
            if w in counts:
                common -= held[w] <= counts[w]
                held[w] -= 1
        lo = max(lo, min(hi, i - reach))
        if common >= least:
            out.add(i)
    return out


def densest(spots: list[int], least: float, gap: int) -> list[int]:
    """The longest stretch of ``spots`` without a gap of over ``gap`` words."""
    cuts = [0, *(i for i in range(1, len(spots)) if spots[i] - spots[i - 1] > gap), len(spots)]
    return max((spots[a:b] for a, b in zip(cuts[:-1], cuts[1:])), key=len)


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_coverage: float = MIN_COVERAGE,
                  templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, n_words, license, coverage, licenses, hits): the best hit and all of them, one row per row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    chosen = TEMPLATES if templates is None else templates

    def run(batches):
        import pyarrow as pa

        scanner = Scanner(chosen, min_coverage)
        hit = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for at, n in text_slices(batch, "text"):
                part = batch.slice(at, n)
                found = [scanner.scan(t) for t in part.column(1).to_pylist()]
                best = [min(h, key=lambda x: (-x[1], x[2] - x[3], x[0])) if h else (None, 0.0) for _, h in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([w for w, _ in found], pa.int64()),
                        pa.array([b[0] for b in best], pa.string()),
                        pa.array([b[1] for b in best], pa.float64()),
                        pa.array([sorted({x[0] for x in h}) for _, h in found], pa.list_(pa.string())),
                        pa.array([[dict(zip(("license", "coverage", "first", "end"), x)) for x in h] for _, h in found], pa.list_(hit)),
                    ],
                    ["doc_id", "n_words", "license", "coverage", "licenses", "hits"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(
        rows,
        run,
        f"doc_id {kind}, n_words bigint, license string, coverage double, licenses array<string>, "
        "hits array<struct<license:string,coverage:double,first:bigint,end:bigint>>",
    )
