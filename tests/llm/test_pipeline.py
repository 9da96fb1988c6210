"""run() against a plain version of every stage, and each stage on awkward tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from recordforge.llm import source_mixing
from recordforge.llm.tokens import tokenizer_path
from test_lsh_forest import brute

EN = "the cat and dog were in house with their friends while it was raining outside this morning".split()
FR = "le chat et chien étaient dans la maison avec leurs amis pendant que pluie tombait dehors ce matin".split()


def corpus():
    rng = random.Random(6)
    rows = []
    for i in range(240):
        words = [rng.choice(EN if i % 3 else FR) + rng.choice(["", "", str(rng.randrange(50))]) for _ in range(rng.randint(3, 60))]
        rows.append([i, " ".join(words), "en" if i % 3 else "fr", rng.choice(["a", "a", "a", "b", "c", None])])
    for i in range(240, 300):  # copies and near copies
        text = rows[rng.randrange(20)][1].split()
        if i % 2:
            text[rng.randrange(len(text))] = "edited"
        rows.append([i, " ".join(text), None, "a"])
    rows += [[400, None, "en", "a"], [401, "", None, "b"], [402, "12 34 !!", "en", "c"], [403, "the " * 9000, "en", "b"]]
    return [tuple(r) for r in rows]


@pytest.fixture
def sf(docs, tmp_path):
    docs(corpus()).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_run_equals_plain_version(spark, sf):
    rows = [r for r in corpus() if r[1] and any(c.isalpha() for c in r[1])]
    classes = brute([(r[0], r[1]) for r in rows])
    rows = [r for r in rows if classes[r[0]][0] == r[0]]
    kept = spark.createDataFrame([(*r, 0) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    copies = {r.doc_id: r.copies for r in source_mixing.mix(kept).collect()}  # held against SQL in test_source_mixing
    tok = Tokenizer.from_file(tokenizer_path(None))
    want = Counter()
    for key, text, _, _ in rows:
        ids = np.asarray([*tok.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        for k, lo in enumerate(range(0, len(ids), 4096)):
            part = ids[lo : lo + 4096]
            want[key, k, lo, len(part), zlib.crc32(part.tobytes())] += copies[key]
    got = P.run(spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == +want
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES[:-1]])
def test_stages_keep_the_columns(spark, sf, docs, stage):
    df = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "1 AS node", "'x' AS size", "2 AS copies")
    out = stage(spark, df, sf)
    assert out.columns == df.columns and out.count() > 0
    assert stage(spark, docs([]), sf).collect() == []


def test_repeated_rows_and_null_ids(spark, docs, sf):
    text = " ".join(EN)
    rows = [(1, text, "en", "a")] * 3 + [(None, text, "en", "a")] * 2 + [(2, "le chat et le chien", "fr", "b")]
    out = P.stage_near_duplicates(spark, docs(rows), sf).collect()
    assert Counter(r.doc_id for r in out) == {1: 1, 2: 1}  # rows without an id are documents, too
    assert P.stage_language(spark, docs(rows), sf).count() == 6
    assert P.stage_mix(spark, docs(rows), sf).count() >= 1
    assert P.stage_pack(spark, docs(rows), sf).count() == 6


def test_distinct_texts_with_equal_or_null_ids_survive(spark, docs, sf):
    # every text has a size of its own; ids are null, all 7, or unique
    texts = [" ".join(f"w{i}x{k}" for k in range(10 + i)) for i in range(60)]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else 100 + i, t, "en", "ab"[i % 2]) for i, t in enumerate(texts)]
    df = docs(rows).repartition(3)
    copies = {r.size: r.copies for r in source_mixing.mix(df).collect()}
    want = {(r[0], r[1]): copies[len(r[1].split())] for r in rows}
    got = Counter((r.doc_id, r.text) for r in P.stage_mix(spark, df, sf).collect())
    assert got == +Counter(want) and {k for k, _ in got} >= {None, 7}

    near = [(1, texts[59] + " more", "en", "a"), (200, texts[58], "fr", "b")]  # of a row with id 100 + 59, and of one with id 7
    out = P.stage_near_duplicates(spark, docs([*rows, *near]), sf).collect()
    gone = {(159, texts[59]), (200, texts[58])}
    assert Counter((r.doc_id, r.text) for r in out) == Counter({(r[0], r[1]) for r in [*rows, *near]} - gone)


def test_rows_equal_in_id_and_size_are_taken_by_content(spark, docs, sf):
    rows = [(None, f"one two {k} four five", "en", "ab"[k % 2]) for k in range(40)]
    runs = [Counter(r.text for r in P.stage_mix(spark, docs(x).repartition(n), sf).collect()) for x, n in ((rows, 1), (rows[::-1], 5))]
    assert runs[0] == runs[1] and len(runs[0]) > 2


def test_a_table_without_labels_keeps_its_documents(spark, docs, sf):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    for lang in (None, "en"):  # no label, or one on a held-out id alone
        rows = [(held, "the cat", lang, "a"), (101, "le chat", None, "b"), (102, "12 !", None, "a"), (103, None, None, "a"), (104, "", None, "a")]
        assert {r.doc_id for r in P.stage_language(spark, docs(rows), sf).collect()} == {held, 101}


def test_near_duplicates_among_rows_without_an_id(spark, docs, sf):
    """A third without an id, a third that share one, against all pairs."""
    given = [r for r in corpus() if r[1] and r[1].strip()]
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else r[0], *r[1:]) for i, r in enumerate(given)]
    rows += [(None, None, "en", "a"), (None, "", "en", "a"), (None, " ", "en", "a"), (None, "", "en", "a")]
    classes = brute([(i, r[1]) for i, r in enumerate(rows)])
    want = Counter()
    for c in {k for k, _ in classes.values()}:
        members = [rows[i] for i, (k, _) in classes.items() if k == c]
        ids = [r[0] for r in members if r[0] is not None]
        want[min(ids) if ids else None] += 1
    want[None] -= 1  # of the two empty texts without an id, one stays
    out = P.stage_near_duplicates(spark, docs(rows).repartition(4), sf).collect()
    assert Counter(r.doc_id for r in out) == want
    texts = {(r.doc_id, r.text) for r in out}
    assert texts <= {(r[0], r[1]) for r in rows}


def test_stages():
    assert [n for n, _ in P.STAGES] == ["language ID", "n-gram Jaccard join", "source mix", "best-fit packing"]
