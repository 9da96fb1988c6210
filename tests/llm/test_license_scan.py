import random
from difflib import SequenceMatcher

from recordforge.llm import license_scan as L
from recordforge.llm.license_templates import TEMPLATES

MIT = next(t for n, t in TEMPLATES if n == "MIT" and len(t) > 200)
APACHE = next(t for n, t in TEMPLATES if n == "Apache-2.0" and len(t) > 200)
FILL = "the quick brown fox and a lazy dog of this or that with any notice "


def names(text):
    return [h[0] for h in L.Scanner(TEMPLATES, 0.8).scan(text)[1]]


def longest_rising(values):
    best = [1] * len(values)
    for i, v in enumerate(values):
        best[i] = max([1, *(best[j] + 1 for j in range(i) if values[j] < v)])
    return max(best, default=0)


def test_rising_is_longest():
    rng = random.Random(1)
    for _ in range(100):
        v = [rng.randrange(30) for _ in range(rng.randint(0, 25))]
        got = [v[i] for i in L.rising(v)]
        assert all(a < b for a, b in zip(got, got[1:])) and len(got) == longest_rising(v)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randint(0, 20))] for _ in range(2))
        pairs = L.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and z < w for (x, z), (y, w) in zip(pairs, pairs[1:]))
    words = L.words_of(MIT)
    assert L.align(words, words) == [(i, i) for i in range(len(words))]


def test_gaps_are_aligned_again():
    # "the" is ambiguous in the whole text, unique between the anchors
    text, template = "the x under the apache the y".split(), "under the apache".split()
    assert len(L.align(text, template)) == 3
    assert SequenceMatcher(None, text, template).find_longest_match().size == 3


def test_notices_and_texts():
    for name, text in TEMPLATES:
        assert names(text) == [name], name
        assert names(f"{FILL * 20}\n{text.upper()}\n{FILL * 20}") == [name], name
    edited = MIT.replace("Software", "Program").replace("substantial portions", "large parts")
    assert names(FILL * 3 + edited) == ["MIT"]
    assert names(f"{MIT}\n{FILL * 30}\n{APACHE}") == ["MIT", "Apache-2.0"]


def test_same_licence_more_than_once():
    notice = "Released under the MIT License."
    assert names(f"{notice} {notice}") == ["MIT", "MIT"]
    assert names(f"{notice} {FILL * 50} {notice} {FILL * 50} Licensed under CC BY-NC 4.0.") == ["MIT", "MIT", "CC-BY-NC-4.0"]
    assert names(f"{MIT} {MIT}") == ["MIT", "MIT"]


def test_every_telling_word_is_tried():
    once = sorted(w for w, c in L.Counter(L.words_of(MIT)).items() if c == 1 and w not in L.COMMON)
    edited = " ".join("changed" if w in once[:5] else w for w in L.words_of(MIT))
    assert names(f"{edited} {MIT} {MIT}") == ["MIT"] * 3
    assert names(f"{edited} {MIT} {edited} {MIT}") == ["MIT"] * 4
    # among other text that has its words, too, in which each telling word stands more often than in the notice, or once
    other = "software is provided as is without warranty of any kind to the authors or holders of software licensed under apache"
    assert names(f"{other} {MIT} {other} {MIT}") == ["MIT"] * 2
    notice = "Licensed under the MIT License."
    assert names(f"licensed work of MIT license under {notice}") == ["MIT"]


AGPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public
License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This
program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."""


def test_licences_that_share_most_words():
    assert names(AGPL) == ["AGPL-3.0"]
    assert names(AGPL.replace("Affero", "Lesser")) == ["LGPL-3.0"]
    assert names(AGPL.replace("Affero ", "")) == ["GPL-3.0"]
    assert names(AGPL.replace("Affero ", "").replace("version 3", "version 2")) == ["GPL-2.0"]
    assert names(AGPL.replace("Affero ", "").replace("version 3", "version 4")) == []
    assert names(f"{AGPL} {FILL} {AGPL.replace('Affero ', '')}") == ["AGPL-3.0", "GPL-3.0"]
    work = "This work is licensed under"
    assert names(f"{work} the GNU General Public License, version 2.") == ["GPL-2.0"]
    assert names(f"{work} the GNU Lesser General Public License, version 2.1.") == ["LGPL-2.1"]
    assert names(f"{work} the GNU Free Documentation License, version 1.3.") == []
    assert names("Licensed under CC BY 3.0.") == ["CC-BY-3.0"]
    assert names("Licensed under CC BY-NC-ND 4.0.") == ["CC-BY-NC-ND-4.0"]
    assert names("Licensed under CC BY 9.0.") == names("Licensed under the Foo License.") == []
    assert names("Licensed under the Apache License, Version 1.1.") == []
    assert names(f"{work} a Creative Commons Attribution-Share Alike 3.0 United States License.") == ["CC-BY-SA-3.0"]
    only = [t for t in TEMPLATES if t[0] in ("GPL-3.0", "CC-BY-4.0", "CC-BY-NC-4.0")]  # the others not listed
    for text in (AGPL, "Licensed under CC BY-NC-ND 4.0.", "Licensed under CC BY-SA 4.0."):
        assert L.Scanner(only, 0.8).scan(text)[1] == []


def test_clean_texts_have_no_hits():
    assert names(FILL * 200) == []
    assert names("A license to thrill: the version of the public work is under way, released or not.") == []
    assert names(MIT[: len(MIT) // 2]) == []
    assert names(None) == names("") == names("...") == []


def test_table(docs):
    rows = [(1, FILL + MIT), (2, None), (3, ""), (4, "word " * 200_000 + APACHE), (5, FILL), (5, FILL), (None, "Released under the MIT License.")]
    got = sorted(((r.doc_id, r.license, r.n_words) for r in L.scan_licenses(docs(rows).selectExpr("*", "1 AS license", "2 AS hits")).collect()), key=repr)
    n = len(L.words_of(FILL))
    want = [(1, "MIT", n + len(L.words_of(MIT))), (2, None, 0), (3, None, 0), (4, "Apache-2.0", 200_000 + len(L.words_of(APACHE)))]
    want += [(5, None, n), (5, None, n), (None, "MIT", 5)]
    assert got == sorted(want, key=repr)
    assert L.scan_licenses(docs([])).collect() == []


def test_many_repeats_are_all_found_in_linear_time():
    scanner = L.Scanner(L.TEMPLATES, L.MIN_COVERAGE)
    notice = "Licensed under the MIT License. "
    n, hits = scanner.scan(notice * 20_000)
    assert n == 100_000 and [h[2:] for h in hits] == [(i, i + 5) for i in range(0, n, 5)] and {h[0] for h in hits} == {"MIT"}
