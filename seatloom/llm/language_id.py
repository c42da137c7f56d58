"""Language ID: a linear-chain conditional random field labels every word with a language.

Emissions are sums of weights of hashed features: the word, its affixes and its character n-grams, and membership in
a lexicon of each language's frequent words. Transitions between the labels of neighbouring words are learned too,
from code-switched sequences spliced of passages in different languages. Forward-backward gives each word's label
distribution; a document's language is the label with the largest sum over its words, its score that sum's share.

Training uses a bounded sample of labelled rows: of the ``languages`` most frequent languages ``docs_per_language`` documents each,
drawn by hash, and of each document ``passages`` passages of ``passage_words`` words, spread evenly over it; these bounds are
parameters. The executors cut the sample to them, so the driver gets no more rows, however large the corpus. The model
(weights of 2**16 features for each language, transitions, lexicons of ``lexicon_words`` words) has a fixed size. Prediction reads
whole texts, and features come from whole words, however long.

Words are runs of letters, lower-cased. Defined cases: a text that is null or has no letter is ``und`` with score 0; with no
labelled rows every text is ``und``; one language only: that language, score 1; rows with null lang aren't
learned from; equal sums go to the first language in code point order; empty input gives empty output; other columns
are ignored and only the text is an input of a prediction.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.llm import words as W
from seatloom.runtime import in_arrow

UNDETERMINED = "und"
BUCKETS = 1 << 16
LANGUAGES, DOCS_PER_LANGUAGE, PASSAGES, PASSAGE_WORDS = 256, 400, 4, 60
LEXICON_WORDS = 300
#: Bounds of what a worker keeps of words it has seen.
CACHE_WORDS, CACHE_LETTERS = 400_000, 1 << 25

_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from: crc32 of doc_id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def tokens(text: str | None) -> list[str]:
    return _LETTERS.findall((text or "").lower())


class Buckets(dict):
    """Feature -> bucket; keeps those asked for, which for affixes and n-grams are few, up to a bound."""

    def __missing__(self, feature: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
        return bucket


_BUCKETS = Buckets()


def features(word: str) -> list[int]:
    """Buckets of a word's features, each once: itself, affixes up to 4 characters, n-grams of 1 to 3 characters; always in one order."""
    fenced, top = f"<{word}>", min(4, len(word)) + 1
    affixes = ["p" + word[:n] for n in range(1, top)] + ["s" + word[-n:] for n in range(1, top)]
    grams = ("g" + fenced[i : i + n] for n in (1, 2, 3) for i in range(len(fenced) - n + 1))
    own = zlib.crc32(b"w" + word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)
    return [own, *dict.fromkeys(map(_BUCKETS.__getitem__, chain(affixes, grams)))]


@dataclass
class Model:
    languages: list[str]
    lexicon: dict[str, int]  # word -> bits of the languages that list it
    weights: np.ndarray  # (BUCKETS + number of languages, number of languages)
    transitions: np.ndarray  # log weights
    start: np.ndarray

    def rows(self, word: str) -> list[int]:
        """Rows of ``weights`` that a word adds up."""
        bits = self.lexicon.get(word, 0)
        return features(word) + [BUCKETS + i for i in range(len(self.languages)) if bits >> i & 1]


def forward_backward(emit: np.ndarray, first: np.ndarray, transitions: np.ndarray, start: np.ndarray, lanes: int = 256, pairs: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
    """Label distributions of words in one stream of sequences.

    ``emit``: log weights (words, labels); ``first``: marks of words that begin a sequence. The stream is cut into lanes
    that advance together: a lane's transfer matrix is the product of its steps, the matrices are chained from
    both ends, then every lane runs forward and backward from exact borders. Memory is words times labels. Returns the marginals and, for training, the expected
    number of transitions between labels.
    """
    n, k = emit.shape
    lanes = max(1, min(lanes, n // 8))
    length = -(-n // lanes)
    e = np.ones((lanes * length, k))
    e[:n] = np.exp(emit - emit.max(axis=1, keepdims=True))
    mark = np.ones(lanes * length, bool)  # padding is sequences of one word
    mark[:n] = first
    mark[0] = True
    e, mark = e.reshape(lanes, length, k), mark.reshape(lanes, length)
    t, s = np.exp(transitions - transitions.max()), np.exp(start - start.max())
    s = s / s.sum()
    through = np.broadcast_to(np.eye(k), (lanes, k, k))
    for i in range(length):
        begins = mark[:, i, None, None]
        # a step inside a sequence multiplies by t; one that begins a sequence gives the start's weights to all that has come
        through = np.where(begins, through.sum(axis=2, keepdims=True) * s, through @ t) * e[:, i, None, :]
        through = through / through.max(axis=(1, 2), keepdims=True)
    left, right = np.empty((lanes, k)), np.empty((lanes, k))
    a = np.full(k, 1 / k)
    for i in range(lanes):
        left[i] = a
        a = a @ through[i]
        a = a / a.sum()
    b = np.ones(k)
    for i in range(lanes - 1, -1, -1):
        right[i] = b
        b = through[i] @ b
        b = b / b.max()
    forward, backward = np.empty_like(e), np.empty_like(e)
    for i in range(length):
        left = np.where(mark[:, i, None], left.sum(axis=1, keepdims=True) * s, left @ t) * e[:, i]
        left = left / left.sum(axis=1, keepdims=True)
        forward[:, i] = left
    for i in range(length - 1, -1, -1):
        backward[:, i] = right
        right = e[:, i] * right
        right = np.where(mark[:, i, None], (right @ s)[:, None], right @ t.T)
        right = right / right.max(axis=1, keepdims=True)
    marginal = forward * backward
    marginal = (marginal / marginal.sum(axis=2, keepdims=True)).reshape(-1, k)[:n]
    if not pairs:
        return marginal, None
    e, f, b, inside = e.reshape(-1, k)[:n], forward.reshape(-1, k)[:n], backward.reshape(-1, k)[:n], ~mark.reshape(-1)[:n]
    f, g = f[:-1][inside[1:]], (e * b)[1:][inside[1:]]
    return marginal, t * ((f / ((f @ t) * g).sum(axis=1, keepdims=True)).T @ g)


def sample(labelled: DataFrame, docs_per_language: int, passages: int, passage_words: int, languages: int = LANGUAGES) -> list[tuple[str, list[list[str]]]]:
    """Bounded training rows: (language, passages of words)."""
    rows = labelled.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.groupBy(F.col("lang").alias("c_lang")).count().orderBy(F.desc("count"), "c_lang").limit(languages)
    # a share of each language by hash, about twice what is wanted; the exact cut follows, before anything is collected
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(2.0 * docs_per_language * (1 << 30)) / F.col("count")
    near = rows.join(F.broadcast(counts), F.col("lang") == F.col("c_lang")).filter(drawn)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = tokens(text)
                starts = sorted({i * max(0, len(own) - passage_words) // max(1, passages - 1) for i in range(passages)})
                # neighbours that overlap are one passage
                cut, end = [], 0
                for a in starts:
                    a = max(a, end)
                    if a < min(len(own), a + passage_words):
                        cut.append(own[a : a + passage_words])
                        end = a + passage_words
                out.append((key, lang, [" ".join(p) for p in cut]))
            keys, langs, cuts = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(langs, pa.string()), pa.array(cuts, pa.list_(pa.string()))], ["key", "lang", "passages"])

    found = in_arrow(near.select(F.xxhash64("doc_id", "text").alias("key"), "text", "lang"), run, "key long, lang string, passages array<string>")
    found = found.filter(F.size("passages") > 0).groupBy("lang", "key").agg(F.min("passages").alias("passages"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("key"))
    kept = found.withColumn("place", place).filter(F.col("place") <= docs_per_language).select("lang", "key", "passages").collect()
    return [(r.lang, [p.split() for p in r.passages]) for r in sorted(kept, key=lambda r: (r.lang, r.key))]


def train(
    labelled: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    passages: int = PASSAGES,
    passage_words: int = PASSAGE_WORDS,
    rounds: int = 60,
    seed: int = 17,
    lexicon_words: int = LEXICON_WORDS,
    languages: int = LANGUAGES,
) -> Model:
    """Fit the field to a bounded sample of labelled rows (doc_id, text, lang) by Adam on its log-likelihood."""
    rows = sample(labelled, docs_per_language, passages, passage_words, languages)
    learned = sorted({lang for lang, _ in rows})
    k, number = len(learned), {lang: i for i, lang in enumerate(learned)}
    counts: list[Counter] = [Counter() for _ in learned]
    for lang, cut in rows:
        for p in cut:
            counts[number[lang]].update(p)
    lexicon: dict[str, int] = {}
    for i, c in enumerate(counts):
        for word, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words]:
            lexicon[word] = lexicon.get(word, 0) | 1 << i
    model = Model(learned, lexicon, np.zeros((BUCKETS + k, k)), np.zeros((k, k)), np.zeros(k))
    if k < 2:
        return model
    # splice: passages in random order, four to a sequence, so labels change within sequences
    rng = np.random.default_rng(seed)
    pieces = [(number[lang], p) for lang, cut in rows for p in cut]
    pieces = [pieces[i] for i in rng.permutation(len(pieces))]
    vocabulary: dict[str, int] = {}
    ids, labels, first = [], [], []
    for at, (label, piece) in enumerate(pieces):
        cut = piece[: int(rng.integers(3, len(piece) + 1))] if len(piece) > 3 else piece
        ids += [vocabulary.setdefault(w, len(vocabulary)) for w in cut]
        labels += [label] * len(cut)
        first += [at % 4 == 0] + [False] * (len(cut) - 1)
    ids, labels, first = np.array(ids), np.array(labels), np.array(first)
    spread = [model.rows(w) for w in vocabulary]
    owner = np.repeat(np.arange(len(spread)), [len(s) for s in spread])
    row = np.concatenate([np.array(s) for s in spread])
    truth = np.eye(k)[labels]
    inside = ~first[1:]
    true_pairs = np.zeros((k, k))
    np.add.at(true_pairs, (labels[:-1][inside], labels[1:][inside]), 1)
    true_start = truth[first].sum(axis=0)
    params = [model.weights, model.transitions, model.start]
    slow, fast = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    heads = np.searchsorted(owner, np.arange(len(spread)))
    by_row = np.argsort(row, kind="stable")
    used, row_heads = np.unique(row[by_row], return_index=True)
    n = len(ids)
    for step in range(1, rounds + 1):
        emit = np.add.reduceat(model.weights[row], heads, axis=0)[ids]
        marginal, pairs = forward_backward(emit, first, model.transitions, model.start)
        by_word = np.zeros((len(spread), k))
        np.add.at(by_word, ids, truth - marginal)
        grad = np.zeros_like(model.weights)
        grad[used] = np.add.reduceat(by_word[owner[by_row]], row_heads, axis=0)
        grads = [grad / n - 1e-6 * model.weights, (true_pairs - pairs) / n - 1e-6 * model.transitions, (true_start - marginal[first].sum(axis=0)) / n]
        for p, g, m, v in zip(params, grads, slow, fast, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights = model.weights.astype(np.float32)
    return model


class Labeller:
    """Labels texts; keeps the emissions of words seen, up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, int] = {}
        self.letters = 0
        self.table = np.zeros((1 << 12, len(model.languages)), np.float32)

    @classmethod
    def of(cls, model: Model) -> Labeller:
        """The model's labeller in this process: tasks that follow use what earlier ones kept."""
        if not hasattr(model, "labeller"):
            model.labeller = cls(model)
        return model.labeller

    def emissions(self, words: list[str]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS or self.letters > CACHE_LETTERS:
            self.known, self.letters = {}, 0
        known = self.known
        new = list({w: None for w in words if w not in known})
        self.letters += sum(map(len, new))
        for a in range(0, len(new), 4096):
            part = new[a : a + 4096]
            rows = [self.model.rows(w) for w in part]
            heads = np.cumsum([0] + [len(r) for r in rows[:-1]])
            sums = np.add.reduceat(self.model.weights[np.fromiter(chain.from_iterable(rows), np.int64)], heads, axis=0)
            at, stop = len(known), len(known) + len(part)
            while stop > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[at:stop] = sums
            known.update(zip(part, range(at, stop), strict=True))
        return self.table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        k = len(self.model.languages)
        found = [tokens(t) for t in texts]
        sizes = np.array([len(w) for w in found], np.int64)
        label, score = np.full(len(texts), -1), np.zeros(len(texts))
        words = [w for own in found for w in own]
        if words and k:
            first = np.zeros(len(words), bool)
            stops = np.cumsum(sizes)
            first[(stops - sizes)[sizes > 0]] = True
            marginal, _ = forward_backward(self.emissions(words).astype(float), first, self.model.transitions, self.model.start, pairs=False)
            some = np.flatnonzero(sizes)
            total = np.add.reduceat(marginal, (stops - sizes)[some], axis=0)
            label[some] = total.argmax(axis=1)
            score[some] = np.minimum(1.0, total.max(axis=1) / sizes[some])
        return [self.model.languages[i] if i >= 0 else UNDETERMINED for i in label], score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Documents -> doc_id, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller.of(sent.value)
        for batch in batches:
            for a, b in W.slices(batch.column(1)):
                langs, scores = labeller.predict(batch.column(1).slice(a, b - a).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Documents of which one language holds at least ``least``; all columns stay. Texts without words are rejected."""
    sent, names = docs.sparkSession.sparkContext.broadcast(model), docs.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller.of(sent.value)
        for batch in batches:
            for a, b in W.slices(batch.column(at)):
                part = batch.slice(a, b - a)
                langs, scores = labeller.predict(part.column(at).to_pylist())
                yield part.filter(pa.array([lang != UNDETERMINED and s >= least for lang, s in zip(langs, scores, strict=True)], pa.bool_()))

    return in_arrow(docs, run, docs.schema)
