"""Subject areas of a message: classifier chains over term, source and structure features.

Terms: a logistic model of words and word pairs, learnt from the sentences of labelled messages, gives each sentence's
probability of each subject (what all kinds of messages have, such as greetings and legal notices, scores as low as the
subject is rare). Chain: for each subject in turn, a logistic model of how many sentences deal with it and how clearly, of
how often messages of the same source have it, of the message's structure, and of the subjects decided before it (so that
subjects that go together or exclude each other are known). It is fitted on sentence scores from models that haven't seen
the message. Labels are incomplete, so the chain's probabilities are divided by how often a clear subject (the main one,
or another) is labelled. The most probable combination in which only subjects that at least two sentences deal with are
chosen is found by beam search; those that aren't chosen count with their factors too.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mail import message_text, own_sentences
from .tokens import texts_of

#: The bound of the sample that is learnt from: labelled messages, taken in the order of a hash of their id.
MOST_LABELLED = 6000
#: A sentence deals with a subject if its score is this part of the way from the subject's share of all messages (about what
#: a sentence that any message may have scores) to 1.
SENTENCE_LIFT = 0.34
LEAST_SENTENCES, BEAM = 2, 16
#: Words of fewer letters are taken as written; longer ones that are unknown may be misspelt.
LEAST_LETTERS = 5
#: Messages whose sentences are scored together.
ROWS_AT_ONCE = 500
#: From this score on a sentence is clear; labels are taken to name at least this share of the subjects.
CLEAR, LEAST_RATE = 0.65, 0.4
_WORDS = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*").findall


def words(sentence: str) -> list[str]:
    return [x.lower() for x in _WORDS(sentence)]


def terms(w: list[str]) -> set[str]:
    """Words, and pairs of neighbouring words."""
    return set(w) | {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}


def read_message(text: str | None) -> tuple[list[str], list[float]]:
    """The author's sentences, and the structure of the message: reply, forward, HTML, several parts."""
    headers, body = message_text(text)
    kind = headers.get("content-type", "").lower()
    return own_sentences(body), [float("in-reply-to" in headers), float(bool(re.match(r"(?i)\s*(fwd?|tr|wg)\b", headers.get("subject", "")))), float("html" in kind), float("multipart" in kind)]


def _source(name: str | None) -> str:
    return (name or "").strip().lower()


def source_odds(sources: list[str], labels: np.ndarray) -> dict[str, np.ndarray]:
    """For every source the log odds of each subject among its messages, drawn towards those of all messages ("\0": of none known)."""
    every = np.clip(labels.mean(0), 1e-3, 1 - 1e-3) if len(labels) else np.full(labels.shape[1], 0.5)
    rate = {"\0": every}
    place: dict[str, list[int]] = {}
    for i, x in enumerate(sources):
        place.setdefault(x, []).append(i)
    for x, rows in place.items():
        rate[x] = (labels[rows].sum(0) + 10 * every) / (len(rows) + 10)
    return {x: np.log(r / (1 - r)) for x, r in rate.items()}


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class TermModel:
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: np.ndarray

    @cached_property
    def _short_of(self) -> dict[str, str]:
        """Known words by what is left of them without one letter; of words that leave the same the first by the alphabet."""
        out: dict[str, str] = {}
        for w in sorted(t for t in self.vocabulary if len(t) >= LEAST_LETTERS and " " not in t):
            for i in range(len(w)):
                out.setdefault(w[:i] + w[i + 1 :], w)
        return out

    def respelled(self, word: str) -> str:
        """The known word of which an unknown one has two neighbouring letters exchanged, lacks a letter, or has one too many."""
        known = self.vocabulary
        for i in range(len(word) - 1):
            swapped = word[:i] + word[i + 1] + word[i] + word[i + 2 :]
            if swapped in known:
                return swapped
        if word in self._short_of:
            return self._short_of[word]
        for i in range(len(word)):
            shorter = word[:i] + word[i + 1 :]
            if len(shorter) >= LEAST_LETTERS and shorter in known:
                return shorter
        return word

    def sentence_scores(self, sentences: list[str]) -> np.ndarray:
        """Probability of each subject in each sentence, for all sentences at once."""
        get, known_word, respelled = self.vocabulary.get, self.vocabulary.__contains__, self.respelled
        rows = []
        for s in sentences:
            w = [x if len(x) < LEAST_LETTERS or known_word(x) else respelled(x) for x in words(s)]
            rows.append([v for v in map(get, terms(w)) if v is not None])
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        out = np.zeros((len(rows), len(self.bias)))
        known = np.flatnonzero(sizes)
        if len(known):
            flat = np.fromiter((v for r in rows for v in r), np.int64, int(sizes.sum()))
            starts = np.concatenate([[0], np.cumsum(sizes[known])[:-1]])
            out[known] = np.add.reduceat(self.weights[flat], starts, axis=0) / np.sqrt(sizes[known])[:, None]
        return _sigmoid(out + self.bias)


def fit_terms(messages: list[list[str]], labels: np.ndarray, *, rounds: int = 2, steps: int = 60, rate: float = 0.5, decay: float = 0.01) -> TermModel:
    """Logistic models of all subjects at once, by full-gradient steps of adaptive size.

    A sentence first has all labels of its message; after the first round it keeps a label as far as its words support it.
    Terms of fewer than two messages are left out.
    """
    found = [[terms(words(s)) for s in m] for m in messages]
    df: dict[str, int] = {}
    for m in found:
        for t in set().union(*m) if m else ():
            df[t] = df.get(t, 0) + 1
    vocabulary = {t: i for i, t in enumerate(sorted(t for t, n in df.items() if n > 1))}
    rows = [[vocabulary[t] for t in s if t in vocabulary] for m in found for s in m]
    k, v, n = labels.shape[1], len(vocabulary), len(rows)
    weights, bias = np.zeros((v, k)), np.full(k, -2.0)
    if not n or not v:
        return TermModel(vocabulary, weights, bias)
    doc = np.repeat(np.arange(len(found)), [len(m) for m in found])
    sizes = np.array([len(r) for r in rows])
    flat, sent = np.array([t for r in rows for t in r], dtype=np.int64), np.repeat(np.arange(n), sizes)
    scale = 1 / np.sqrt(np.maximum(sizes, 1))[sent]
    target = labels[doc]
    for r in range(rounds):
        weights, bias = np.zeros((v, k)), np.full(k, -2.0)
        gw, gb = np.full((v, k), 1e-8), np.full(k, 1e-8)
        for _ in range(steps):
            z = np.stack([np.bincount(sent, weights=weights[flat, j] * scale, minlength=n) for j in range(k)], 1)
            p = _sigmoid(z + bias)
            error = (p - target) / n
            g = np.stack([np.bincount(flat, weights=error[sent, j] * scale, minlength=v) for j in range(k)], 1) + decay * weights / n
            gw += g * g
            weights -= rate * g / np.sqrt(gw)
            b = error.sum(0)
            gb += b * b
            bias -= rate * b / np.sqrt(gb)
        if r + 1 < rounds:
            target = labels[doc] * np.where(p > 0.35, 1.0, p)
    return TermModel(vocabulary, weights.astype(np.float32), bias)


def cuts(labels: np.ndarray) -> np.ndarray:
    """The score from which on a sentence deals with each subject."""
    share = labels.mean(0) if len(labels) else np.zeros(labels.shape[1])
    return share + SENTENCE_LIFT * (1 - share)


def evidence(scores: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """For each subject: whether one, two, three or more sentences deal with it, the clearest two scores, and the share."""
    k = scores.shape[1]
    top = -np.sort(-np.vstack([scores, np.zeros((2, k))]), axis=0)[:2]
    n = (scores > cut).sum(0)
    return np.stack([n >= 1, n >= 2, n >= 3, n >= 4, top[0], top[1], n / max(1, len(scores))], 1).astype(float)


def fit_logistic(x: np.ndarray, y: np.ndarray, decay: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a ridge logistic regression, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + decay * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - y) + decay * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class SubjectModel:
    subjects: list[str]
    order: list[int]
    term_model: TermModel
    sources: dict[str, np.ndarray]
    chain: list[np.ndarray]
    labelled_rate: np.ndarray
    cut: np.ndarray

    def decide(self, scores: np.ndarray, structure: list[float], source: str | None) -> list[str]:
        """The most probable combination of the subjects that enough sentences deal with, by beam search along the chain."""
        enough = (scores > self.cut).sum(0) >= LEAST_SENTENCES
        if not enough.any():
            return []
        ev, common = evidence(scores, self.cut), shared_features(len(scores), structure)
        odds = self.sources.get(_source(source), self.sources["\0"])
        rate = np.where(ev[:, 6] >= ev[:, 6].max(), *self.labelled_rate)
        # log probability, places in the chain of the subjects chosen; one of too few sentences stays 0, with its factor
        beam: list[tuple[float, list[int]]] = [(0.0, [])]
        for at, j in enumerate(self.order):
            w, x = self.chain[at], np.concatenate([common, ev[j], odds[j : j + 1]])
            fixed, r = float(w[: len(x)] @ x), float(rate[j])
            before = w[len(x) :].tolist()
            grown = []
            for logp, chosen in beam:
                z = fixed + sum(before[c] for c in chosen)
                p = min(0.999, max(0.001, 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) / r))
                grown.append((logp + math.log(1 - p), chosen))
                if enough[j]:
                    grown.append((logp + math.log(p), [*chosen, at]))
            beam = sorted(grown, key=lambda b: -b[0])[:BEAM]
        return [self.subjects[self.order[at]] for at in beam[0][1]]


def shared_features(n_sentences: int, structure: list[float]) -> np.ndarray:
    return np.array([1.0, np.log1p(n_sentences), *structure])


def fit(messages: list[tuple[list[str], list[float], str | None]], labels: np.ndarray, subjects: list[str]) -> SubjectModel:
    """Fit on messages (sentences, structure, source) and their label matrix."""
    texts = [m[0] for m in messages]
    names = [_source(m[2]) for m in messages]
    order = [int(j) for j in np.argsort(-labels.sum(0), kind="stable")]
    model = SubjectModel(subjects, order, fit_terms(texts, labels), source_odds(names, labels), [], np.ones(2), cuts(labels))
    half = np.arange(len(texts)) % 2
    scores: list[np.ndarray] = [np.zeros((0, len(subjects)))] * len(texts)
    odds = np.zeros(labels.shape)
    for part in (0, 1):  # scores and odds of messages that the models haven't seen
        seen = np.flatnonzero(half != part)
        other, elsewhere = fit_terms([texts[i] for i in seen], labels[seen]), source_odds([names[i] for i in seen], labels[seen])
        for i in np.flatnonzero(half == part):
            scores[i] = other.sentence_scores(texts[i])
            odds[i] = elsewhere.get(names[i], elsewhere["\0"])
    if not messages:
        width = len(shared_features(0, [0.0] * 4)) + 8
        model.chain = [np.zeros(width + at) for at in range(len(subjects))]
        return model
    common = np.stack([shared_features(len(t), m[1]) for t, m in zip(texts, messages, strict=True)])
    ev = np.stack([evidence(s, model.cut) for s in scores])
    for at, j in enumerate(order):
        x = np.hstack([common, ev[:, j], odds[:, j : j + 1], labels[:, order[:at]]])
        model.chain.append(fit_logistic(x, labels[:, j]))
    # how often a subject that two sentences or more clearly deal with is labelled: the main one of a message, and others
    main = ev[:, :, 6] >= ev[:, :, 6].max(1, keepdims=True)
    for kind in (0, 1):
        given = labels[(ev[:, :, 1] > 0) & (ev[:, :, 5] >= CLEAR) & (main == (kind == 0))]
        model.labelled_rate[kind] = max(LEAST_RATE, (given.sum() + 2) / (len(given) + 2))
    return model


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        read = [read_message(t) for t in texts_of(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("given"), pa.array([r[0] for r in read], pa.list_(pa.string())), pa.array([r[1] for r in read], pa.list_(pa.float64()))], names=["doc_id", "source", "given", "sentences", "structure"])


def learn(documents: DataFrame, labels: DataFrame, subjects: DataFrame, *, most_labelled: int = MOST_LABELLED) -> SubjectModel:
    """A model of the labelled documents; ``most_labelled`` bounds them, and with that what the driver and the model hold.

    Labels that (without regard to case and spaces) name no subject don't count; a document has all subjects that any of
    its labels gives.
    """
    names = sorted(r[0] for r in subjects.select("subject").dropna().distinct().collect())
    code = F.lower(F.trim("subject"))
    given = labels.select("doc_id", code.alias("subject")).filter(F.col("subject").isin(names) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.sort_array(F.collect_set("subject")).alias("given"))
    sample = F.broadcast(given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labelled))  # at most most_labelled ids
    read = documents.select("doc_id", "source", "text").join(sample, "doc_id").select("doc_id", "source", "text", "given").mapInArrow(_read, "doc_id bigint, source string, given array<string>, sentences array<string>, structure array<double>")
    rows = sorted(read.collect(), key=lambda r: (r["doc_id"], r["sentences"]))[:most_labelled]
    matrix = np.array([[float(s in r["given"]) for s in names] for r in rows]).reshape(len(rows), len(names))
    return fit([(r["sentences"], r["structure"], r["source"]) for r in rows], matrix, names)


def subject_areas(documents: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, subject): the subjects of every document, none for those without text or without a subject.

    One narrow pass over whole texts. Repeated doc_ids give the subjects of each of their rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the sample the model was learnt from

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: SubjectModel = shared.value
        for whole in batches:
            ids, found = [], []
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(first, ROWS_AT_ONCE)
                read = [read_message(t) for t in texts_of(b.column("text"))]
                ends = np.cumsum([len(r[0]) for r in read])
                scores = m.term_model.sentence_scores([s for r in read for s in r[0]])
                for d, source, (sentences, structure), end in zip(b.column("doc_id").to_pylist(), b.column("source").to_pylist(), read, ends, strict=True):
                    if sentences and m.subjects:
                        for s in m.decide(scores[end - len(sentences) : end], structure, source):
                            ids.append(d)
                            found.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["doc_id", "subject"])

    return documents.select("doc_id", "source", "text").mapInArrow(run, "doc_id bigint, subject string")
