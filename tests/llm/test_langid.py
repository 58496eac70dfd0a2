import random
import zlib

import numpy as np
import pytest

from jobtide.llm import langid

SCHEMA = "doc_id long, text string, lang string, score string"
WORDS = {
    "en": "the and of to in is that for was with".split(),
    "de": "der und die das nicht mit für ist auf ein".split(),
    "es": "de la que el en los del las por año".split(),
}


def corpus(rows, seed=1):
    draw = random.Random(seed)
    out = []
    for i in range(rows):
        lang = draw.choice(sorted(WORDS))
        out.append((i, " ".join(draw.choices(WORDS[lang], k=draw.randrange(5, 60))), lang, "x"))
    return out


def test_held_out_accuracy_and_folds(spark):
    rows = corpus(900)
    result = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    held = [row for row in rows if zlib.crc32(str(row[0]).encode()) % 5 == 0]
    assert {i for i, r in result.items() if r.held_out} == {row[0] for row in held}
    right = sum(result[i].lang_pred == lang for i, _, lang, _ in held)
    assert right >= 0.97 * len(held)
    assert all(0.0 <= r.score <= 1.0 for r in result.values())


def test_learns_nothing_from_held_out_rows(spark):
    rows = corpus(300)
    wrong = [
        (i, t, "xx" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows
    ]
    one = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    two = langid.identify(spark.createDataFrame(wrong, SCHEMA)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_edge_cases(spark):
    rows = corpus(200) + [
        (1000, None, "en", ""), (1001, "", "en", ""), (1002, "12 %% !!", "de", ""),
        (None, "the and of to", "en", ""), (1003, "und die das nicht", None, ""),
        (1004, "die das " * 50_000, "de", ""), (1004, "die das " * 50_000, "de", ""),
    ]
    result = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(result) == len(rows)
    by_id = {r.doc_id: r for r in result}
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[None].held_out is True  # the checksum of an empty text is 0
    assert by_id[1003].lang_pred == by_id[1004].lang_pred == "de"


@pytest.mark.parametrize("rows", [[], [(1, "some text", None, "")]])
def test_nothing_to_learn_from(spark, rows):
    result = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.lang_pred for r in result] == ["und"] * len(rows)


def test_known_language_keeps_columns(spark):
    rows = corpus(200) + [(1000, None, "en", ""), (1002, "12", "de", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = langid.known_language(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == list(range(200))


def test_counts_by_hand_are_independent_of_pieces(monkeypatch):
    text = "Ein Straßenname, und 12 weitere Wörter. " * 40
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "_STEP", 17)
    assert np.array_equal(langid.counts(text), whole)


def test_fit_is_sparse_and_separates():
    draw = np.random.default_rng(0)
    rows, targets = [], []
    for i in range(400):
        at = np.unique(np.append(draw.integers(10, 2000, 20), i % 2))
        rows.append((at, np.full(len(at), 1 / np.sqrt(len(at)))))
        targets.append(i % 2)
    weights, bias = langid.fit(rows, np.array(targets), 2)
    assert (weights == 0).mean() > 0.5
    right = [(weights[:, at] @ v + bias).argmax() == t for (at, v), t in zip(rows, targets, strict=True)]
    assert np.mean(right) > 0.97


def test_signs_beyond_the_first_plane_are_no_letters(spark):
    rows = corpus(200) + [(1000, "🎉🎈 😀", None, ""), (1001, "🎉🎈 😀", "en", ""), (1002, "𐐀𐐁𐐂", None, "")]
    result = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(result[i].lang_pred, result[i].score) for i in (1000, 1001)] == [("und", 0.0)] * 2
    assert result[1002].lang_pred != "und"
    assert (langid.counts("the 🎉 and") == langid.counts("the % and")).all()


def test_rare_languages_are_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(langid, "LANGUAGE_ROWS", 15)
    rows = corpus(3000) + [(5000 + i, "wrth gan ddim y mae hynny yn", "cy", "") for i in range(20)]
    model = langid.fitted(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == ["cy", "de", "en", "es"]
    assert langid.predict(model, "gan ddim y mae wrth")[0] == "cy"


def test_a_row_that_is_everywhere_is_learnt_and_sent_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 60)
    monkeypatch.setattr(langid, "LANGUAGE_ROWS", 20)
    english = [row for row in corpus(2400) if row[2] == "en"]
    hot = "die und das nicht mit von zu"
    for doc in (1, None):  # copies of one row, and of one text under many ids
        rows = english + [(doc or 10_000 + i, hot, "de", "") for i in range(2000)]
        df = spark.createDataFrame(rows, SCHEMA)
        sizes = []
        fit = langid.fit
        monkeypatch.setattr(langid, "fit", lambda v, t, c: sizes.append(np.bincount(t).tolist()) or fit(v, t, c))
        models = [langid.fitted(d) for d in (df.repartition(2), df.repartition(7, "text"))]
        monkeypatch.setattr(langid, "fit", fit)
        assert models[0].languages == ["de", "en"] and np.array_equal(models[0].weights, models[1].weights)
        assert all(10 < n < 120 for n in sizes[0])
        assert langid.predict(models[0], hot)[0] == "de"


def test_no_more_languages_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    rows = corpus(300) + [(5000 + i, "wrth gan ddim y mae hynny yn", f"x{i}", "") for i in range(50)]
    assert len(langid.fitted(spark.createDataFrame(rows, SCHEMA)).languages) == 2
