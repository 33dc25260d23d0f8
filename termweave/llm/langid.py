"""Language of documents and of stretches in another language: error-correcting output codes over character n-grams.

Each language has a codeword of ``BITS`` bits; the code is chosen by a seeded search for a large least distance. One binary classifier per
bit (naive Bayes over hashed character 1- to 3-grams of folded words, each with a blank on both sides) votes for its bit with a margin.
A sentence's margin is the sum of its words', so a worker counts the grams of a word once, however often it meets it. Decoding adds, for each
language, the logistic losses of all margins against its codeword, weighted by how well each bit did on held-out sentences; the language
with the least loss is nearest. The softmax of the losses is the confidence; a sentence whose best two lie close is ambiguous and goes
with its neighbour.

Training takes labelled documents: at most ``SAMPLE_DOCS`` per language, those with the smallest hash of their id of the ones with at most
``SAMPLE_CHARS`` characters. Nothing else is bounded. Labels may be wrong and documents mixed, so training runs twice: sentences the first model
gives to another language are left out of the second. All else reads every document whole.

Null or letterless text has no segment. Null labels count as missing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 24
SIZE = 1 << 15
SAMPLE_DOCS, SAMPLE_CHARS, LEAST_DOCS = 200, 20_000, 3
#: A sentence whose best language has less confidence is ambiguous; it may go with a neighbour whose language has at least POSSIBLE.
SURE, POSSIBLE = 0.9, 0.05
#: Lengths to which held-out sentences are cut to find the temperature of the confidence: on whole ones there are hardly any errors to learn from.
FRAGMENTS = (6, 10, 16, 28)
SEED = 7

#: Words up to so many characters are remembered, so many of them at a time.
SHORT_WORD, WORDS = 40, 200_000

#: Tags, bracketed codes and quoted words say nothing about the language of a sentence, and don't end one. Each pattern stops at the next mark
#: that opens it again or at the end of the line, so a text is passed over once however its marks are paired. A straight quote opens
#: where no letter or digit of a spaced script stands before it, and closes where none follows.
_QUOTED = r"“[^“”\n]*+”|„[^„“\n]*+“|«[^«»\n]*+»|(?<![0-9A-Za-z])\"(?=\S)[^\"\n]*+(?<=\S)\"(?![0-9A-Za-z])"
_ASIDE = re.compile(rf"<[^<>\n]*+>|\[[^\[\]\n]*+\]|{_QUOTED}")
#: A sentence ends at . ! ? before white space, a tag, a closing mark or the end, after 。！？ anywhere, and at an empty line.
_END = re.compile(rf"(?P<aside>{_ASIDE.pattern})|(?<![.!?…])[.!?…]++[)\]”\"'»]*+(?=\s|<|$)|[。！？]++[”」』）]*+|\n(?:[^\S\n]*+\n)++")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Combining diacritical marks.
_MARKS = re.compile("[\u0300-\u036f]+")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences; together they hold every character that isn't between two of them as white space."""
    out, at = [], 0
    for m in _END.finditer(text):
        if m["aside"] and not (m[0][-2] in ".!?…。！？" and m[0][-1] not in ">]" and (m.end() == len(text) or text[m.end()].isspace())):
            continue
        if text[at : m.end()].strip():
            out.append((at, m.end()))
            at = m.end()
    if text[at:].strip():
        out.append((at, len(text)))
    return out


def folded(text: str) -> str:
    """Lower case, no diacritics, runs of letters parted by one blank, a blank at both ends; '' if there is no letter."""
    plain = _ASIDE.sub(" ", text).lower()
    if not plain.isascii():
        plain = _MARKS.sub("", unicodedata.normalize("NFKD", plain))
    found = _LETTERS.findall(plain)
    return f" {' '.join(found)} " if found else ""


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts in a row, and the place where each text begins. Texts must not be empty."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in texts])
    ends = np.cumsum(lengths)
    n = len(codes)
    room = np.repeat(ends, lengths) - np.arange(n)  # characters left in the text
    one = codes * np.uint64(0x9E3779B97F4A7C15)
    grams = np.full((n, 3), SIZE, dtype=np.int64)
    h = one
    for k in range(3):
        if k:
            h = h[:-1] * np.uint64(0xBF58476D1CE4E5B9) + one[k:]
        slots = ((h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(49)
        # a gram that would pass the end of its text stays in the last slot, which weighs nothing
        grams[: n - k, k] = np.where(room[: n - k] > k, slots.astype(np.int64), SIZE)
    return grams.reshape(-1), (ends - lengths) * 3


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray  # languages x BITS, +1 or -1
    weights: np.ndarray  # (SIZE + 1) x BITS
    trust: np.ndarray  # BITS, sums to BITS
    sharp: float = 1.0  # inverse temperature

    def __post_init__(self) -> None:
        self.rows: dict[str, int] = {}  # short words met, and their margins
        self.met = np.zeros((1024, BITS), dtype=np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "met")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def _words(self, words: list[str]) -> np.ndarray:
        """Margins of words: sums of the weights of their grams. 2,000 at a time, as they come."""
        out = []
        for i in range(0, len(words), 2000):
            grams, at = _features([f" {w} " for w in words[i : i + 2000]])
            out.append(np.add.reduceat(self.weights[grams], at, axis=0))
        return np.concatenate(out)

    def margins(self, texts: list[str]) -> np.ndarray:
        """texts x BITS. Texts are folded and have a word each."""
        split = [t.split() for t in texts]
        words = [w for ws in split for w in ws]
        new = [w for w in dict.fromkeys(words) if w not in self.rows]
        if len(self.rows) + len(new) > WORDS:
            self.rows.clear()
            new = list(dict.fromkeys(words))
        short = [w for w in new if len(w) <= SHORT_WORD]
        n = len(self.rows)
        if n + len(new) > len(self.met):
            self.met = np.concatenate([self.met, np.zeros((n + 2 * len(new), BITS), dtype=np.float32)])
        if new:  # short words first: they stay, the long ones' rows are used again
            order = [*short, *[w for w in new if len(w) > SHORT_WORD]]
            self.met[n : n + len(order)] = self._words(order)
            self.rows.update(zip(order, range(n, n + len(order))))
        at = np.fromiter(map(self.rows.__getitem__, words), dtype=np.int64, count=len(words))
        starts = np.cumsum([0, *map(len, split)])[:-1]
        sums = np.add.reduceat(self.met[at], starts, axis=0)
        for w in new:
            if len(w) > SHORT_WORD:
                del self.rows[w]
        return sums

    def chances(self, losses: np.ndarray) -> np.ndarray:
        """Softmax of the losses; rows sum to 1."""
        e = np.exp(-(losses - losses.min(axis=1, keepdims=True)) * self.sharp)
        return e / e.sum(axis=1, keepdims=True)

    def losses(self, texts: list[str]) -> np.ndarray:
        """texts x languages: weighted mean logistic loss per bit."""
        if not self.langs:
            return np.zeros((len(texts), 0))
        out = []
        for i in range(0, len(texts), 512):
            part = texts[i : i + 512]
            margins = self.margins(part) / np.sqrt(np.array([len(t) for t in part]))[:, None]
            # the loss of a bit is log(1 + exp(-z)), and that of the other sign is z more: so one matrix product does for all languages
            up, down = np.logaddexp(0, -margins) * self.trust, np.logaddexp(0, margins) * self.trust
            out.append((up @ (self.code > 0).T.astype(np.float32) + down @ (self.code < 0).T.astype(np.float32)) / BITS)
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)))


def codewords(n: int, bits: int = BITS, seed: int = SEED) -> np.ndarray:
    """n codewords whose least distance is the largest of many seeded draws, bits balanced over the languages."""
    rng, best, most = np.random.default_rng(seed), None, -1
    for _ in range(400):
        code = np.ones((n, bits), dtype=np.int8)
        for b in range(bits):
            code[rng.permutation(n)[: max(1, n // 2) if n > 1 else 0], b] = -1
        far = min((int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)), default=bits)
        if far > most:
            best, most = code, far
    return best.astype(np.float32)


def _fit(texts: list[str], langs: list[str], labels: list[str]) -> Model:
    code = codewords(len(labels))
    index = {x: i for i, x in enumerate(labels)}
    counts = np.zeros((len(labels), SIZE + 1))
    held = []
    for lang in labels:
        own = [t for t, y in zip(texts, langs) if y == lang]
        for i in range(0, len(own), 2000):
            part = [t for j, t in enumerate(own[i : i + 2000], i) if j % 5 or len(own) < 10]
            if part:
                counts[index[lang]] += np.bincount(_features([f" {w} " for t in part for w in t.split()])[0], minlength=SIZE + 1)
        held += [(t, lang) for j, t in enumerate(own) if not j % 5]
    counts[:, SIZE] = 0
    rates = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
    # a language weighs the same however many documents it has
    weights = np.zeros((SIZE + 1, BITS), dtype=np.float32)
    floor = 1e-6
    for b in range(BITS):
        one, two = rates[code[:, b] > 0], rates[code[:, b] < 0]
        if len(one) and len(two):
            weights[:, b] = np.log(one.mean(axis=0) + floor) - np.log(two.mean(axis=0) + floor)
    weights[SIZE] = 0
    model = Model(labels, code, weights, np.ones(BITS, dtype=np.float32))
    if held:
        texts_, ys = [t for t, _ in held], np.array([index[y] for _, y in held])
        right = np.zeros(BITS)
        for i in range(0, len(texts_), 512):
            right += ((model.margins(texts_[i : i + 512]) * code[ys[i : i + 512]]) > 0).sum(axis=0)
        odds = np.clip(right / len(texts_), 0.5, 0.999)
        trust = np.log(odds / (1 - odds)) + 1e-3
        model.trust = (trust * BITS / trust.sum()).astype(np.float32)
        cut = [(f" {t[k : k + n].strip()} ", y) for t, y in held for n in FRAGMENTS for k in (len(t) // 3,) if t[k : k + n].strip()]
        losses, right = model.losses([t for t, _ in cut]), [index[y] for _, y in cut]
        scored = []
        for sharp in 2.0 ** np.arange(-2, 6):
            model.sharp = float(sharp)
            scored.append((-np.log(np.maximum(model.chances(losses)[np.arange(len(cut)), right], 1e-12)).mean(), float(sharp)))
        model.sharp = min(scored)[1] if cut else 1.0
    return model


def train(docs: list[tuple[str, str]]) -> Model:
    """From (language, text) of labelled documents, some of them wrong."""
    n_docs: dict[str, int] = {}
    for lang, _ in docs:
        n_docs[lang] = n_docs.get(lang, 0) + 1
    labels = sorted(x for x, n in n_docs.items() if n >= LEAST_DOCS)
    texts, langs = [], []
    for lang, text in docs:
        if lang in labels:
            for a, b in sentences(text):
                if t := folded(text[a:b]):
                    texts.append(t)
                    langs.append(lang)
    if not texts:
        return Model([], np.zeros((0, BITS)), np.zeros((SIZE + 1, BITS), np.float32), np.ones(BITS))
    model = _fit(texts, langs, labels)
    for _ in range(2):
        said = model.losses(texts).argmin(axis=1)
        kept = [i for i, y in enumerate(langs) if model.langs[said[i]] == y]
        have = {x: sum(1 for i in kept if langs[i] == x) for x in labels}
        labels = [x for x in labels if have[x] >= max(1, 0.5 * sum(1 for y in langs if y == x))] or labels
        pairs = [(texts[i], langs[i]) for i in kept if langs[i] in labels]
        model = _fit([t for t, _ in pairs], [y for _, y in pairs], labels)
    return model


def label_of(lang: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(lang, F.lit("")), r"^\s+|\s+$", ""))


def training_docs(docs: DataFrame, codes: list[tuple[str, str, str]]) -> list[tuple[str, str]]:
    """The bounded sample: (ISO 639-1 code, text) of documents whose label means exactly one language."""
    means: dict[str, set[str]] = {}
    for row in codes:
        for c in row:
            means.setdefault(c.strip().lower(), set()).add(row[0])
    single = {c: next(iter(s)) for c, s in means.items() if len(s) == 1}
    if not single:
        return []
    mapping = F.create_map(*[F.lit(x) for kv in sorted(single.items()) for x in kv])
    usable = docs.select("doc_id", F.try_element_at(mapping, label_of(F.col("lang"))).alias("y"), "text").filter(F.col("y").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
    w = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    # ids first: the ranking (kept to SAMPLE_DOCS rows per partition before its shuffle) moves no text
    ids = usable.select("doc_id", "y").withColumn("r", F.row_number().over(w)).filter(F.col("r") <= SAMPLE_DOCS).select("doc_id", "y")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").orderBy("doc_id").collect()
    return [(r["y"], r["text"]) for r in rows]


SEGMENTS = "doc_id long, lang string, n_segments int, seg int, start int, stop int, n_sentences int, found string, confidence double, ambiguous int"


def _label(model: Model, texts: list[str]) -> list[list[tuple[int, int, int, str, float, int]]]:
    """Segments (start, stop, sentences, language, confidence, ambiguous sentences) of each text."""
    spans, folds, owner = [], [], []
    for i, t in enumerate(texts):
        for a, b in sentences(t):
            spans.append((a, b))
            folds.append(folded(t[a:b]))
            owner.append(i)
    chances = np.zeros((len(folds), len(model.langs)))
    lettered = [j for j, f in enumerate(folds) if f]
    if lettered and model.langs:
        chances[lettered] = model.chances(model.losses([folds[j] for j in lettered]))
    out: list[list] = [[] for _ in texts]
    start = 0
    for i in range(len(texts)):
        stop = start
        while stop < len(owner) and owner[stop] == i:
            stop += 1
        out[i] = _segments(model, spans[start:stop], chances[start:stop])
        start = stop
    return out


def _segments(model: Model, spans: list[tuple[int, int]], chances: np.ndarray) -> list[tuple[int, int, int, str, float, int]]:
    """``chances`` has a row per sentence, zeros where there is no letter. One pass in each direction.

    Sentences without a letter have no say in the confidence.
    """
    n = len(spans)
    if not n or not chances.shape[1]:
        return []
    best, top = chances.argmax(axis=1).tolist(), chances.max(axis=1).tolist()
    said = [b if p > 0 else None for b, p in zip(best, top)]
    doubt = [0 < p < SURE for p in top]
    # the last sure language before, and the next after: a doubtful sentence goes with the one before, or else the one after
    beside: list[int | None] = [None] * n
    last = None
    for j in range(n):
        if said[j] is not None and not doubt[j]:
            last = best[j]
        else:
            beside[j] = last
    last = None
    for j in range(n - 1, -1, -1):
        if said[j] is not None and not doubt[j]:
            last = best[j]
        elif beside[j] is None:
            beside[j] = last
    for j, k in enumerate(beside):
        if k is not None and (said[j] is None or chances[j, k] >= POSSIBLE):
            said[j] = k
    out: list[list] = []
    for j, (a, b) in enumerate(spans):
        if said[j] is None:
            if out:
                out[-1][1] = b
            continue
        lettered = top[j] > 0
        p, lang = float(chances[j, said[j]]) if lettered else 0.0, model.langs[said[j]]
        if out and out[-1][3] == lang:
            s = out[-1]
            s[1], s[2], s[4], s[5], s[6] = b, s[2] + 1, s[4] + p, s[5] + doubt[j], s[6] + lettered
        else:
            out.append([a, b, 1, lang, p, int(doubt[j]), int(lettered)])
    return [(a, b, m, x, p / of if of else 1.0, d) for a, b, m, x, p, d, of in out]


def segments(docs: DataFrame, codes: list[tuple[str, str, str]], model: Model | None = None) -> DataFrame:
    """One row per segment of every document: SEGMENTS. ``lang`` is the label the document came with."""
    spark = docs.sparkSession
    model = model or train(training_docs(docs, codes))
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            ids, langs, texts = (b.column(i).to_pylist() for i in range(3))
            for at in range(0, len(ids), 200):  # bounds the memory of one step
                part = _label(m, [t or "" for t in texts[at : at + 200]])
                rows = [(ids[at + i], langs[at + i], len(segs), k, *s) for i, segs in enumerate(part) for k, s in enumerate(segs, 1)]
                cols = list(zip(*rows)) if rows else [[]] * 10
                types = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["doc_id", "lang", "n_segments", "seg", "start", "stop", "n_sentences", "found", "confidence", "ambiguous"])

    return docs.select("doc_id", "lang", "text").mapInArrow(run, SEGMENTS)


def label_fits(codes: list[tuple[str, str, str]]) -> Column:
    """Whether the label is one of the three codes of the found language."""
    ok = F.lit(False)
    for row in codes:
        ok = ok | ((F.col("found") == row[0]) & label_of(F.col("lang")).isin([c.strip().lower() for c in row]))
    return ok


def documents(segs: DataFrame) -> DataFrame:
    """One row per document: its main language (most characters, then the earlier segment), confidence, number of segments."""
    size = F.col("stop") - F.col("start")
    by_lang = segs.groupBy("doc_id", "lang", "found").agg(F.sum(size).alias("chars"), F.sum(F.col("confidence") * size).alias("c"), F.min("seg").alias("first"), F.max("n_segments").alias("n"), F.sum("ambiguous").alias("ambiguous"))
    best = F.struct("chars", (-F.col("first")).alias("f"), "found", "c")
    return by_lang.groupBy("doc_id", "lang").agg(F.max(best).alias("b"), F.max("n").alias("n_segments"), F.sum("ambiguous").alias("n_ambiguous")).select(
        "doc_id", "lang", F.col("b.found").alias("found"), F.when(F.col("b.chars") > 0, F.col("b.c") / F.col("b.chars")).otherwise(1.0).alias("confidence"), "n_segments", "n_ambiguous"
    )


def mislabelled(segs: DataFrame, codes: list[tuple[str, str, str]]) -> DataFrame:
    """All segments of documents that have several, or whose label doesn't fit: doc_id, seg, lang. No shuffle."""
    return segs.filter((F.col("n_segments") > 1) | ~label_fits(codes)).select("doc_id", "seg", F.col("found").alias("lang"))
