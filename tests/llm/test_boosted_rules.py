import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from recordforge.llm import boosted_rules as br

WORDS = ["a", "bb", "Über", "x.", "12", "#*", "$%&|<>", "the", "ein ", "\t", "\n", " \n", "\r\n", "\x0b", "\x85", "　", "的", "a\nbb", "the the the"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def texts(n, seed=1):
    rng = random.Random(seed)
    return [None, "", " ", "\n\n", "a", "a b", "a b c a b c", *("".join(rng.choice(WORDS) + rng.choice([" ", "", "\n"]) for _ in range(rng.randint(0, 60))) for _ in range(n))]


def test_statistics_equal_the_definition():
    given = texts(600)
    for column in (pa.array(given, pa.string()), pa.array(["skip", *given], pa.string()).slice(1)):
        got = list(zip(*(x.tolist() for x in br.count_statistics(column)[: len(br.BASE)])))
        assert got == [plain(t) for t in given]
    assert [x.tolist() for x in br.count_statistics(pa.array([], pa.string()))] == [[]] * len(br.STATISTICS)


def recursive(model, t, row, node=0):
    if 2 * node + 1 >= model.value.shape[1]:
        return model.value[t, node]
    return recursive(model, t, row, 2 * node + 1 + int(row[model.feature[t, node]] > model.above[t, node]))


def test_flattened_trees_and_falling_features():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    good = (rng.random(3000) < 1 / (1 + np.exp(6 * x[:, 0] - 4 * x[:, 1] + np.sin(9 * x[:, 0]) - 1))).astype(float)
    model = br.fit_trees(x, good, falling=(0,), trees=30)
    p = model.score(x[:50])
    by_hand = [1 / (1 + np.exp(-model.base - sum(recursive(model, t, r) for t in range(30)))) for r in x[:50]]
    assert np.allclose(p, by_hand)
    for r in x[:200]:
        line = np.repeat(r[None], 60, axis=0)
        line[:, 0] = np.linspace(-0.5, 1.5, 60)
        assert (np.diff(model.score(line)) <= 1e-12).all()
    free = br.fit_trees(x, good, trees=30)
    rising = [np.diff(free.score(np.column_stack([np.linspace(0, 1, 60), np.full((60, 3), 0.5)]))).max()]
    assert max(rising) > 1e-6  # without the constraint it does rise somewhere
    y = (x[:, 1] > 0.5).astype(float)
    assert ((br.fit_trees(x, y).score(x) > 0.5) == y).mean() > 0.99


def corpus(spark, n=300):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    rows, labels = [], []
    for k in range(n):
        words = [word() for _ in range(rng.randint(60, 200))]
        bad = k % 5 == 0
        rows.append((k, " ".join(w + rng.choice(["###", "$$$"]) if bad and rng.random() < 0.8 else w for w in words) + "."))
        labels.append((k, int(not bad), 0))
    return rows, labels


def test_verdicts(spark, docs):
    rows, labels = corpus(spark)
    extra = [(None, None), (None, "short"), (1, rows[0][1]), (10_000, " ".join(["one two three"] * 60)), (10_001, rows[3][1])]
    table = docs(rows + extra).withColumn("quality", F.lit("clash")).withColumn("n_words", F.lit(None)).repartition(3)
    marks = spark.createDataFrame(labels + [(2, 0, 0), (2, 1, 0), (None, 1, 0), (3, None, 0), (4, 7, 0), (99_999, 0, 0)], "doc_id bigint, quality int, toxic int")
    out = br.quality_rules(table, marks).collect()
    assert len(out) == len(rows) + len(extra)
    for r in out:
        if r["doc_id"] is None:
            assert r["base_failed"] and not r["kept"]
        elif r["doc_id"] == 10_000:
            assert r["base_failed"] and not r["kept"] and r["n_repeat_words"] == r["n_words"] == 180
        elif r["doc_id"] != 1:
            assert not r["base_failed"] and r["kept"] == (r["doc_id"] % 5 != 0 or r["doc_id"] == 10_000 + 5)
    assert sorted(r["kept"] for r in out if r["doc_id"] == 1) == [False, True]  # a bad text under a good id is judged by itself


def test_no_labels_or_one_kind(spark, docs):
    rows, labels = corpus(spark, 60)
    for marks in ([], [(k, 1, 0) for k, _, _ in labels], [(k, None, 0) for k, _, _ in labels]):
        df = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
        out = br.quality_rules(docs(rows), df).collect()
        assert all(r["kept"] != r["base_failed"] and r["quality"] is None for r in out) and len(out) == 60
    assert br.quality_rules(docs([]), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect() == []


def test_sample_bound_and_order_of_rows(spark, docs):
    rows, labels = corpus(spark)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    one = br.quality_rules(docs(rows).repartition(2), marks, sample_docs=150).select("doc_id", "quality").collect()
    two = br.quality_rules(docs(rows[::-1]).repartition(7), marks.repartition(5), sample_docs=150).select("doc_id", "quality").collect()
    assert dict(map(tuple, one)) == dict(map(tuple, two))


def test_a_very_long_text():
    text = "abc def ghi " * 200_000
    got = [x[0] for x in br.count_statistics(pa.array([text]))[: len(br.BASE)]]
    assert got == [600_000, 1_800_000, 0, 0, 600_000]


def test_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    seen = br.quality_rules(docs, labels.filter("doc_id % 2 = 0")).select("doc_id", "kept", "base_failed")
    rest = seen.join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed").toPandas()
    clean, bad = rest[rest.quality == 1], rest[rest.quality == 0]
    print("clean kept", clean.kept.mean(), "bad rejected", 1 - bad.kept.mean())
    assert clean.kept.mean() >= 0.99 and bad.kept.mean() <= 0.05
