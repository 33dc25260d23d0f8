import pickle
import random
import time

import numpy as np
import pytest

from termweave.llm import langid

CODES = [("en", "eng", "ENG"), ("de", "deu", "GER"), ("es", "spa", "SPA"), ("hr", "hrv", "SCR"), ("sr", "srp", "SCR")]
PARTS = {
    "en": ("the patient group", "shows a slow loss of", "weight during the night", "because nobody had checked it"),
    "de": ("die kleine Gruppe", "zeigt einen langsamen", "Verlust des Gewichts", "weil niemand es geprüft hatte"),
    "es": ("el grupo de enfermos", "muestra una lenta", "pérdida de peso", "porque nadie lo había revisado"),
}


def sentence(rng, lang):
    p = list(PARTS[lang])
    return f"{rng.choice(p).capitalize()} {rng.choice(p)} {rng.choice(p)} {rng.choice(['kelo', 'Maruva', 'tisepo'])}."


def corpus(n, seed):
    """(doc_id, lang, text) and the true segments."""
    rng, docs, truth = random.Random(seed), [], {}
    for i in range(n):
        langs = [rng.choice("en de es".split())]
        if rng.random() < 0.2:
            langs.append(rng.choice([x for x in PARTS if x != langs[0]]))
        text = "\n\n".join(" ".join(sentence(rng, x) for _ in range(rng.randint(1, 4))) for x in langs)
        if rng.random() < 0.2:
            text = f"[C001] <p>{text}</p>"
        label = rng.choice([langs[0]] * 6 + [langs[0].upper(), None, "xx", rng.choice("en de es".split())])
        docs.append((i, label, text))
        truth[i] = langs
    return docs, truth


@pytest.fixture(scope="module")
def done(spark):
    docs, truth = corpus(600, 1)
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, lang string, text string, seg int")
    return docs, truth, langid.segments(df, CODES)


def test_segments(done):
    docs, truth, segs = done
    got = {}
    for r in sorted(segs.collect(), key=lambda r: (r.doc_id, r.seg)):
        got.setdefault(r.doc_id, []).append(r.found)
        assert 0 <= r.confidence <= 1 and r.start < r.stop <= len(docs[r.doc_id][2])
    assert sum(got.get(i) == t for i, t in truth.items()) >= 0.99 * len(truth)


def test_mislabelled(done):
    docs, truth, segs = done
    codes = {c.lower(): r[0] for r in CODES for c in r}
    got = {r.doc_id for r in langid.mislabelled(segs, CODES).collect()}
    want = {i for i, lang, _ in docs if len(truth[i]) > 1 or codes.get((lang or "").strip().lower()) != truth[i][0]}
    assert len(got ^ want) <= 0.01 * len(docs)


def test_held_out_accuracy():
    train, held = corpus(400, 2), corpus(400, 3)
    m = langid.train([(lang.lower(), text) for _, lang, text in train[0] if lang and lang.lower() in PARTS])
    out = langid._label(m, [t for _, _, t in held[0]])
    assert sum([s[3] for s in o] == held[1][i] for i, o in enumerate(out)) >= 0.98 * 400


def test_documents(done, rows):
    _, truth, segs = done
    d = {r.doc_id: r for r in langid.documents(segs).collect()}
    assert len(d) == len(truth) and sum(d[i].found in t and d[i].n_segments == len(t) for i, t in truth.items()) >= 0.99 * len(truth)


def test_sentences_and_asides():
    text = 'One “zwei. drei” four. Five!  [C1]\n\nSix? 七。八'
    assert [text[a:b].strip() for a, b in langid.sentences(text)] == ["One “zwei. drei” four.", "Five!", "[C1]", "Six?", "七。", "八"]
    text = "So “it. ends.” Then <b>on</b>. (Yes.) No"
    assert [text[a:b].strip() for a, b in langid.sentences(text)] == ["So “it. ends.”", "Then <b>on</b>.", "(Yes.)", "No"]
    assert langid.sentences("") == [] and langid.sentences(" \n ") == []
    assert langid.folded("<p>Été “nein” [C01] 12") == " ete " and langid.folded("12 .") == ""


def test_edge_cases(spark):
    docs, _ = corpus(200, 5)
    extra = [(1000, "en", None), (1001, None, ""), (1002, "de", "12 34. !"), (1003, " GER\t", "Die kleine Gruppe zeigt einen langsamen Verlust. " * 4000), (1004, "SCR", "x")]
    df = spark.createDataFrame(docs + extra, "doc_id long, lang string, text string")
    segs = langid.segments(df, CODES)
    got = {r.doc_id: r for r in segs.filter("doc_id >= 1000").collect()}
    assert set(got) == {1003, 1004} and got[1003].found == "de" and got[1003].n_sentences == 4000
    assert 1003 not in {r.doc_id for r in langid.mislabelled(segs, CODES).collect()}
    assert langid.segments(df.limit(0), CODES).count() == 0


def test_codewords_are_far_apart():
    code = langid.codewords(12)
    assert min((code[i] != code[j]).sum() for i in range(12) for j in range(i)) >= 8


def test_confidence_is_fitted_on_every_language(monkeypatch):
    scored = []
    plain = langid.Model.losses
    monkeypatch.setattr(langid.Model, "losses", lambda self, texts: scored.extend(texts) or plain(self, texts))
    letters = {"aa": "b", "bb": "c", "cc": "d"}
    texts = [(f" {x * 20} ", y) for y, x in letters.items() for _ in range(7500)]  # 1,500 of each are held out
    langid._fit([t for t, _ in texts], [y for _, y in texts], list(letters))
    assert {x: sum(x in t for t in scored) for x in letters.values()} == dict.fromkeys(letters.values(), 1500 * len(langid.FRAGMENTS))


def test_quotes_tags_and_brackets_of_any_length():
    rng = random.Random(9)
    inner = " ".join(sentence(rng, "de") for _ in range(40)).rstrip(".")
    for a, b in ("“”", "„“", "«»", '""', "<>", "[]"):
        text = f"the patient group shows {a}{inner}{b} a slow loss of weight."
        assert len(langid.sentences(text)) == 1 and langid.folded(text) == " the patient group shows a slow loss of weight "
    # marks that never close hide nothing; an inch mark opens no quote
    assert langid.folded('a 5" tube. and 6" more') == " a tube and more " and langid.folded('so "open. end') == " so open end "
    hard = ('"a' * 20_000, "<" * 50_000, "“" * 50_000, "." * 50_000 + "x", "[a" * 30_000, "\n " * 40_000)
    began = time.process_time()
    for text in hard:
        langid.sentences(text)
        langid.folded(text)
    assert time.process_time() - began < 5


def test_many_doubtful_sentences_and_confidence():
    m = langid.Model(["de", "en"], langid.codewords(2), np.zeros((langid.SIZE + 1, langid.BITS), np.float32), np.ones(langid.BITS))
    n = 100_000
    chances = np.tile([0.6, 0.4], (n, 1))
    chances[-1] = [0.01, 0.99]
    began = time.process_time()
    assert langid._segments(m, [(i, i + 1) for i in range(n)], chances) == [(0, n, n, "en", pytest.approx(0.4, abs=1e-4), n - 1)]
    assert time.process_time() - began < 3
    # a sentence without a letter goes with its neighbour and leaves the confidence as it is
    assert langid._segments(m, [(0, 5), (5, 9)], np.array([[0.01, 0.99], [0.0, 0.0]])) == [(0, 9, 2, "en", 0.99, 0)]
    # the one before comes first, then the one after; without either a sentence keeps its best
    assert [s[3] for s in langid._segments(m, [(0, 1), (1, 2), (2, 3)], np.array([[0.99, 0.01], [0.4, 0.6], [0.01, 0.99]]))] == ["de", "en"]
    assert [s[3] for s in langid._segments(m, [(0, 1)], np.array([[0.4, 0.6]]))] == ["en"]


def test_words_are_scored_alike_whatever_was_met_before(monkeypatch):
    train, _ = corpus(200, 2)
    m = langid.train([(lang.lower(), text) for _, lang, text in train if lang and lang.lower() in PARTS])
    rng = random.Random(4)
    texts = [f" {' '.join(''.join(rng.choices('abcdeü', k=rng.choice([1, 3, 7, 60]))) for _ in range(rng.randint(1, 9)))} " for _ in range(300)]
    want = np.concatenate([pickle.loads(pickle.dumps(m)).margins([t]) for t in texts])
    monkeypatch.setattr(langid, "WORDS", 50)
    for k in (1, 7, 300):
        got = np.concatenate([m.margins(texts[i : i + k]) for i in range(0, 300, k)])
        assert np.allclose(got, want, rtol=1e-4, atol=1e-3)
