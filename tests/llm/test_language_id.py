import zlib

import numpy as np

from recordforge.llm import language_id as L

EN = "the cat and the dog were in the house with their friends while it was raining outside this morning "
FR = "le chat et le chien étaient dans la maison avec leurs amis pendant que la pluie tombait dehors ce matin "
DE = "die katze und der hund waren im haus mit ihren freunden während es heute morgen draußen regnete und "


def model():
    return L.Model.train({"en": [EN * 3], "fr": [FR * 3], "de": [DE * 3]})


def phrases_by_hand(text, k, window):
    """Greedy longest matches by substring search in the sample."""
    m = model()
    codes, _ = L.to_classes([text], m.classes)
    sample = bytes(L.to_classes([(EN, FR, DE)[["en", "fr", "de"].index(k)] * 3], m.classes)[0][: L.DOC_CLASSES].tolist())
    count = 0
    for at in range(0, len(codes), window):
        z, i = bytes(codes[at : at + window].tolist()), 0
        while i < len(z):
            n = 0
            while i + n < len(z) and z[i : i + n + 1] in sample:
                n += 1
            i += max(1, n)
            count += 1
    return count


def test_phrases_equal_longest_matches():
    m = model()
    texts = ["the dog was in the maison", "und und und", EN[5:60] + FR[3:40], "a" * 30, "rain " * 300]
    for window in (16, 512):
        got, _ = m.phrases(texts, window)
        for row, text in zip(got, texts):
            for k, lang in enumerate(m.languages):
                assert row[k] == phrases_by_hand(text, lang, window), (text, lang, window)


def test_a_text_does_not_depend_on_its_batch():
    m = model()
    texts = [EN, None, "", "123 !!", FR * 40, "Katze.", "x"]
    whole, _ = m.phrases(texts)
    for t, row in zip(texts, whole):
        assert (m.phrases([t])[0][0] == row).all()


def test_predictions_and_undetermined():
    lang, score, _ = model().predict([EN[10:70], FR[8:70].upper(), "der hund, im haus!", None, "", " 12 .. ☃", "\n"])
    assert lang == ["en", "fr", "de", "und", "und", "und", "und"]
    assert (score[3:] == 0).all() and (score[:3] > 0.9).all() and (score <= 1).all()


def test_letters_of_many_scripts_tell_languages_apart():
    """Two languages in letters that are rare among all: the same words' shapes, different letters."""
    rare = {"xa": [chr(0x4E00 + k) for k in range(400)], "xb": [chr(0x5E00 + k) for k in range(400)]}
    rng = np.random.default_rng(5)
    text = {k: "".join(rng.choice(v, 3000)) for k, v in rare.items()}
    latin = {"en": [EN * 30], "fr": [FR * 30], "de": [DE * 30]}
    latin["zz"] = ["".join(chr(0x1200 + k) for k in range(70)) * 50]  # 70 letters more frequent than those
    m = L.Model.train(latin | {k: [v] for k, v in text.items()})
    texts = [text["xa"][50:90], text["xb"][700:760], EN[10:70], FR[8:70], "и" + text["xa"][:9] + EN[:20]]
    assert m.predict(texts[:4])[0] == ["xa", "xb", "en", "fr"]
    # dense on all letters, dense on own letters, and listed moves agree
    codes, bounds = L.to_classes([text["xa"]], m.classes)
    moves, width = L.suffix_automaton(codes[: L.DOC_CLASSES].tolist()), int(m.classes.max()) + 2
    kinds = [L.Moves(moves, width, cells) for cells in (10**8, len(moves) * width - 1, 0)]
    assert [(k.columns is None, k.keys is None) for k in kinds] == [(True, True), (False, True), (False, False)]
    at = m.languages.index("xa")
    counts = [L.Model(["xa"], m.classes, [k.parts()], [1.0]).phrases(texts, 16)[0].tolist() for k in kinds]
    assert counts[0] == counts[1] == counts[2] == m.phrases(texts, 16)[0][:, at : at + 1].tolist()


def test_every_sampled_document_is_learnt_from(monkeypatch):
    monkeypatch.setattr(L, "SAMPLE_CLASSES", 300)
    m = L.Model.train({"en": [EN * 20, "zebras vex quizzical jackdaws"], "fr": [FR]})
    assert m.phrases(["zebras vex quizzical jackdaws"])[0][0, 0] == 1
    assert L.equal_shares(np.array([10, 50, 500]), 2000, 200) == 140


def test_ties_go_to_the_smaller_name():
    m = L.Model.train({"b": [EN], "a": [EN]})
    assert m.predict(["the dog"])[0] == ["a"] and np.isclose(m.predict(["the dog"])[1][0], 0.5)


def test_table_with_nulls_repeats_extra_columns_and_long_text(docs):
    rows = [(i, (EN, FR, DE)[i % 3] * (1 + i % 4), ("en", "fr", "de")[i % 3]) for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, EN * 3000, None), (103, FR, None), (103, FR, None), (None, DE, None), (104, "42", "fr")]
    df = docs(rows).selectExpr("*", "1 AS score", "2 AS lang_pred")
    got = {r.doc_id: r for r in L.language_id(df).collect()}
    assert [got[k].lang_pred for k in (100, 101, 102, 103, None, 104)] == ["und", "und", "en", "fr", "de", "und"]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(60))
    assert all(got[i].lang_pred == ("en", "fr", "de")[i % 3] for i in range(60))
    assert L.language_id(df).count() == len(rows)


def test_held_out_labels_are_not_learnt(docs):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, EN, "xx") for i in held] + [(i, EN, "en") for i in range(200) if i not in held]
    assert {r.lang_pred for r in L.language_id(docs(rows)).collect()} == {"en"}


def test_nothing_to_learn_from_and_empty(docs):
    assert {r.lang_pred for r in L.language_id(docs([(1, EN), (2, None)])).collect()} == {"und"}
    assert L.language_id(docs([])).collect() == []


def test_held_out_accuracy(spark, sf_dir="/root/testdata/sf0.01"):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = L.language_id(df).filter("held_out").join(df.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
