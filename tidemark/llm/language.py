"""Language of a text by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from copy import copy
from hashlib import sha256
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.distinct_words import WordMemory
from tidemark.llm.store import stored
from tidemark.operators import ranks

UNKNOWN = "und"
EDGE, SYMBOLS = 256, 257
#: Bytes of a word that the network reads in one go; a longer word is read in parts.
PART = 40


class Network:
    """Forward and backward gated units over the bytes of a word, and a label for every position."""

    def __init__(self, labels: Sequence[str], hidden: int = 8, seed: int = 20265) -> None:
        rng = np.random.default_rng(seed)
        self.labels, self.hidden = list(labels), hidden
        self.weights: dict[str, np.ndarray] = {}
        for side in "fb":
            self.weights[f"{side}_in"] = rng.normal(0, 0.3, (SYMBOLS, 3 * hidden)).astype(np.float32)
            self.weights[f"{side}_state"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
        self.weights["out"] = rng.normal(0, (2 * hidden)**-0.5, (2 * hidden, len(self.labels))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(self.labels), np.float32)
        self.known: frozenset[str] | None = None        # characters that training showed; None: no record of them

    def digest(self) -> str:
        """Name of the labels, known characters and weights."""
        parts = [repr(self.labels).encode(), repr(self.known and sorted(self.known)).encode(), *[w.tobytes() for _, w in sorted(self.weights.items())]]
        return sha256(b"".join(parts)).hexdigest()

    def _run(self, side: str, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States by time for symbols by time; ``keep`` collects what going back needs."""
        h, u = self.hidden, self.weights[f"{side}_state"]
        given = [np.ascontiguousarray(self.weights[f"{side}_in"][:, k:k + h]) for k in (0, h, 2 * h)]     # a table per gate: all that follows is contiguous
        states, state = np.empty((*x.shape, h), u.dtype), np.zeros((x.shape[1], h), u.dtype)
        for t in range(len(x)):
            inner = state @ u
            z, r, fresh = (w.take(x[t], axis=0) for w in given)
            z += inner[:, :h]
            r += inner[:, h:2 * h]
            inner = np.ascontiguousarray(inner[:, 2 * h:])
            for gate in (z, r):
                np.negative(gate, out=gate)
                np.exp(gate, out=gate)
                gate += 1
                np.divide(1, gate, out=gate)
            fresh += r * inner
            np.tanh(fresh, out=fresh)
            if keep is not None:
                keep.append((state, z, r, fresh, inner))
            state = np.subtract(state, fresh, out=states[t])
            state *= z
            state += fresh
        return states

    def _back(self, side: str, x: np.ndarray, kept: list, towards: np.ndarray, into: dict[str, np.ndarray]) -> None:
        """Gradients of one direction by going back through time; ``towards`` is the loss's slope at every state."""
        h, u = self.hidden, self.weights[f"{side}_state"]
        slope_u, carried = np.zeros_like(u), np.zeros_like(towards[0])
        slopes = [np.empty((*x.shape, h), towards.dtype) for _ in range(3)]
        d_inner = np.empty((x.shape[1], 3 * h), towards.dtype)
        for t in range(len(x) - 1, -1, -1):
            state, z, r, fresh, inner = kept[t]
            d_z, d_r, d_fresh = (s[t] for s in slopes)
            d, rest = towards[t] + carried, 1 - z
            np.multiply(d, rest, out=d_fresh)
            d_fresh *= 1 - fresh * fresh
            np.multiply(d, state - fresh, out=d_z)
            d_z *= z
            d_z *= rest
            np.multiply(d_fresh, inner, out=d_r)
            d_r *= r
            d_r *= 1 - r
            d_inner[:, :h], d_inner[:, h:2 * h] = d_z, d_r
            np.multiply(d_fresh, r, out=d_inner[:, 2 * h:])
            slope_u += state.T @ d_inner
            d *= z
            d += d_inner @ u.T
            carried = d
        into[f"{side}_state"] = slope_u
        at = (x.reshape(-1, 1).astype(np.intp) * h + np.arange(h)).ravel()
        sums = [np.zeros(SYMBOLS * h, towards.dtype) for _ in slopes]
        for total, slope in zip(sums, slopes, strict=True):
            np.add.at(total, at, slope.ravel())         # flat: much faster than by rows
        into[f"{side}_in"] = np.concatenate([total.reshape(SYMBOLS, h) for total in sums], axis=1)

    def _chances(self, states: np.ndarray) -> np.ndarray:
        scores = states @ self.weights["out"] + self.weights["bias"]
        scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
        return scores / scores.sum(axis=-1, keepdims=True)

    def _both(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._run("f", x), self._run("b", x[::-1])[::-1]], axis=2)

    def copy(self) -> Network:
        other = copy(self)
        other.weights = {k: w.copy() for k, w in self.weights.items()}
        return other

    def slopes(self, x: np.ndarray, y: np.ndarray, uses: np.ndarray | None = None) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions of words of one length, and its gradient by weight; a word counts once, or by ``uses``."""
        kept_f, kept_b, into = [], [], {}
        both = np.concatenate([self._run("f", x, kept_f), self._run("b", x[::-1], kept_b)[::-1]], axis=2)
        chances, n = self._chances(both), x.size
        d = chances.copy()
        d[:, np.arange(len(y)), y] -= 1
        share = np.full(len(y), 1 / n, np.float32) if uses is None else (uses / uses.sum() / len(x)).astype(np.float32)
        d *= share[:, None]
        into["out"] = both.reshape(n, -1).T @ d.reshape(n, -1)
        into["bias"] = d.sum(axis=(0, 1))
        towards = d @ self.weights["out"].T
        self._back("f", x, kept_f, towards[:, :, :self.hidden], into)
        self._back("b", x[::-1], kept_b, towards[::-1, :, self.hidden:], into)
        return float((-np.log(chances[:, np.arange(len(y)), y] + 1e-12) * share).sum()), into

    def fit(self, words: Sequence[bytes], labels: Sequence[int], steps: int = 500, batch: int = 256, rate: float = 0.02,
            seed: int = 20266) -> Network:
        """Adam on batches of words of equal length, a length as often as the words that have it."""
        rng, lengths, labels = np.random.default_rng(seed), np.array([len(w) for w in words]), np.asarray(labels)
        moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in self.weights.items()}
        of_length = {n: np.flatnonzero(lengths == n) for n in np.unique(lengths).tolist()}
        for step in range(1, steps + 1):
            same = of_length[int(lengths[rng.integers(len(words))])]
            some = rng.choice(same, min(batch, len(same)), replace=False)
            _, slopes = self.slopes(_symbols([words[k] for k in some]), labels[some])
            pace = rate * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, w in self.weights.items():
                m, v = moments[k]
                m += 0.1 * (slopes[k] - m)
                v += 0.001 * (slopes[k]**2 - v)
                w -= pace * m / (np.sqrt(v) + 1e-8)
        return self

    def pass_over(self, words: Sequence[bytes], labels: Sequence[int], uses: np.ndarray, turn: int, turns: int, steps: int = 60,
                  batch: int = 1024, rate: float = 0.02) -> Network:
        """Adam over all words, in batches of one length, as often as makes up ``steps``; a batch pulls by its share of all uses."""
        rng, labels, lengths = np.random.default_rng(20266 + turn), np.asarray(labels), np.array([len(w) for w in words])
        moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in self.weights.items()}
        step, total = 0, float(uses.sum())
        while step < steps:
            order = rng.permutation(len(words))
            batches = [same[at:at + batch] for n in np.unique(lengths).tolist() for same in [order[lengths[order] == n]] for at in range(0, len(same), batch)]
            planned = len(batches) * -(-steps // len(batches))
            for k in rng.permutation(len(batches)).tolist():
                some, step = batches[k], step + 1
                _, slopes = self.slopes(_symbols([words[w] for w in some]), labels[some], uses[some])
                pull = np.float32(float(uses[some].sum()) / total * len(batches))
                pace = rate * (1 - (turn + step / (planned + 1)) / turns) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for name, w in self.weights.items():
                    m, v = moments[name]
                    slope = pull * slopes[name]
                    m += 0.1 * (slope - m)
                    v += 0.001 * (slope**2 - v)
                    w -= pace * m / (np.sqrt(v) + 1e-8)
        return self

    def evidence(self, words: Sequence[str]) -> np.ndarray:
        """``sums`` in which what training never showed tells nothing: all positions of a word without a letter, and
        the share of a word's positions that its unknown characters take, count with the same chance of every label."""
        found = self.sums(words)
        for k, word in enumerate(words):
            size = len(word.encode("utf-8", "surrogatepass"))
            odd = sum(len(c.encode("utf-8", "surrogatepass")) for c in word if c not in self.known) if self.known is not None else 0
            share = odd / size if any(c.isalpha() for c in word) else 1.0
            if share:
                found[k, :-1] = (1 - share) * found[k, :-1] + share * found[k, -1] / len(self.labels)
        return found

    def sums(self, words: Sequence[str]) -> np.ndarray:
        """A row for each word: the sums of label chances over its positions, and the number of positions."""
        parts, owner = [word.encode("utf-8", "surrogatepass") for word in words], None
        by_length = np.fromiter(map(len, parts), np.int64, len(parts))
        if len(parts) and by_length.max() > PART:
            owner = np.repeat(np.arange(len(words)), np.maximum(1, -(-by_length // PART)))
            for k in np.flatnonzero(by_length > PART)[::-1].tolist():
                parts[k:k + 1] = parts_of(words[k])
            by_length = np.fromiter(map(len, parts), np.int64, len(parts))
        found = np.empty((len(parts), len(self.labels) + 1))
        for length in np.unique(by_length):
            places = np.flatnonzero(by_length == length)
            for k in range(0, len(places), 4096):
                some = places[k:k + 4096]
                found[some, :-1] = self._chances(self._both(_symbols([parts[p] for p in some.tolist()]))).sum(axis=0)
                found[some, -1] = length + 2
        if owner is None:
            return found
        return np.add.reduceat(found, np.flatnonzero(np.diff(owner, prepend=-1)))


def _symbols(words: Sequence[bytes]) -> np.ndarray:
    """Symbols by time: the bytes of words of one length between two edges."""
    inner = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).T
    edge = np.full((1, len(words)), EDGE)
    return np.concatenate([edge, inner, edge])


def _taught(docs: DataFrame, id_col: str, text_col: str, label_col: str, kinds: str = "wctd") -> DataFrame:
    """``(label, kind, key, n)`` of all labelled texts with words, stored: ``w`` the parts of words by use, ``c`` the characters
    by texts that hold them, ``t`` the texts, ``d`` the distinct words with a letter; only the ``kinds`` asked for are counted."""
    rows = (docs.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(label_col).alias("label"), F.col(text_col).alias("text")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                found: dict[str, tuple[Counter, Counter, list[int]]] = {}
                for label, text in zip(*(c.to_pylist() for c in batch.slice(k, 512).columns), strict=True):
                    words = text.split()
                    if words:
                        uses, letters, texts = found.setdefault(label, (Counter(), Counter(), [0]))
                        uses.update(words)
                        if "c" in kinds:
                            letters.update(set(text))
                        texts[0] += 1
                for label, (uses, letters, texts) in found.items():
                    for kind in kinds:
                        if kind == "w":
                            told = _part_uses(uses)
                        elif kind == "c":
                            told = {c.encode("utf-8", "surrogatepass"): n for c, n in letters.items()}
                        elif kind == "d":
                            told = {w.encode("utf-8", "surrogatepass"): 1 for w in uses if any(map(str.isalpha, w))}
                        else:
                            told = {b"": texts[0]}
                        if told:
                            yield pa.RecordBatch.from_arrays(
                                [pa.repeat(label, len(told)), pa.repeat(kind, len(told)), pa.array(told, pa.binary()), pa.array(told.values(), pa.int64())],
                                ["label", "kind", "key", "n"])

    counted = rows.mapInArrow(count, "label string, kind string, key binary, n long")
    return stored(counted.groupBy("label", "kind", "key").agg(F.sum("n").alias("n")), "taught")


def _part_uses(uses: Counter[str]) -> dict[bytes, int]:
    """Uses of words by part; a word of one part is that part."""
    parts: dict[bytes, int] = {}
    for word, n in uses.items():
        raw = word.encode("utf-8", "surrogatepass")
        for part in (raw,) if len(raw) <= PART else parts_of(word):
            parts[part] = parts.get(part, 0) + n
    return parts


def parts_of(word: str) -> list[bytes]:
    """The bytes of a word as the network reads them: in one part, or a long word in several."""
    raw = word.encode("utf-8", "surrogatepass")
    return [raw[at:at + PART] for at in range(0, len(raw), PART)] or [raw]


def _known(taught: DataFrame) -> frozenset[str]:
    """Characters in at least one of 100 texts of a language, and in two: a stray text in it makes no script known."""
    texts = taught.where("kind = 't'").select("label", F.col("n").alias("texts"))
    enough = F.least(F.col("texts"), F.greatest(F.lit(2), F.col("texts") / 100))
    often = taught.where("kind = 'c'").join(texts, "label").where(F.col("n") >= enough).select("key").distinct()
    return frozenset(bytes(r.key).decode("utf-8", "surrogatepass") for r in often.collect())        # no more than there are characters


def least_score(network: Network, held_out: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> float:
    """The evidence score below which a text is in none of the network's languages.

    A text has to look at least as much like one language as single words do: the
    limit is the score that all but one of 10,000 words reach by themselves, among all
    distinct words with a letter of the labelled texts which the network was not fitted
    on.  A text in a known language, of however few words, is about as good as its
    words; one of unknown characters, or with few letters among other signs, is
    below.  The best of n chances is never below 1/n, where such texts lie, so the
    limit suits any number of languages.  Without such texts or labels it is 0.
    """
    if not network.labels:
        return 0.0
    words = _taught(held_out, id_col, text_col, label_col, "d").select("key").distinct()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = network.evidence([w.decode("utf-8", "surrogatepass") for w in batch.column(0).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(found[:, :-1].max(axis=1) / found[:, -1])], ["score"])

    scores = words.mapInArrow(judge, "score double").withColumn("all", F.lit(1))
    limit = ranks.group_quantiles(scores, ["all"], "score", {"limit": 0.0001}).first()
    return float(limit["limit"]) if limit else 0.0


#: Distinct parts of words that one task learns from by itself, tasks at most, and rounds after each of which their networks are averaged.
PARTS_PER_LOT, MOST_LOTS, ROUNDS = 32_768, 256, 6


def _learner(network: Network, turn: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What a lot makes of the network in one round."""
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["key", "label"])
        labels, uses = [network.labels.index(k) for k in rows["label"]], rows["n"].to_numpy(float)
        own = network.copy().pass_over(list(rows["key"]), labels, uses, turn, ROUNDS)
        raw = b"".join(own.weights[k].astype(np.float32).tobytes() for k in sorted(own.weights))
        return pd.DataFrame({"lot": [int(rows["lot"].iloc[0])], "uses": [uses.sum()], "raw": [raw]})

    return learn


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Network:
    """A network fitted on all words of all labelled texts.

    Words are counted by label first, and the distinct ones dealt into lots by hash.
    Lots take turns: in a round some of them pass over all of their words, by their
    numbers of uses, and their networks are averaged by the uses they saw.  After all
    rounds every lot had its turn, and the driver got one network of each.

    Rows with a null label or a text without words teach nothing; without any
    other row the network knows no language.
    """
    taught = _taught(docs, id_col, text_col, label_col, "wct")
    network = Network(sorted(r.label for r in taught.where("kind = 't'").select("label").collect()))      # a row per language
    network.known = _known(taught)
    words = taught.where("kind = 'w'").select("label", "key", "n")
    lots = max(1, min(MOST_LOTS, -(-words.count() // PARTS_PER_LOT)))
    dealt = words.withColumn("lot", F.pmod(F.xxhash64("label", "key"), F.lit(lots)))
    names = sorted(network.weights)
    for turn in range(ROUNDS if network.labels else 0):
        turns = dealt.where(F.col("lot") % min(ROUNDS, lots) == turn % min(ROUNDS, lots))
        found = sorted(turns.groupBy("lot").applyInPandas(_learner(network, turn), "lot long, uses double, raw binary").collect())
        mean = np.average([np.frombuffer(r.raw, np.float32) for r in found], axis=0, weights=[r.uses for r in found])
        network = network.copy()
        at = 0
        for k in names:
            shape, size = network.weights[k].shape, network.weights[k].size
            network.weights[k] = mean[at:at + size].reshape(shape).astype(np.float32)
            at += size
    return network


def predictor(network: Network, evidence: bool = False) -> Callable[[Sequence[str | None]], list[tuple[str, float]]]:
    """Language and score of texts: mean chance over all positions of all words; each distinct word is read once per memory.

    With ``evidence`` the score counts what training never showed as equal chances of all languages.
    """
    rows = [np.empty((0, len(network.labels) + 1))]

    def work(words: list[str]) -> range:
        rows[0] = np.concatenate([rows[0] if memory.found else rows[0][:0], (network.evidence if evidence else network.sums)(words)])
        return range(len(rows[0]) - len(words), len(rows[0]))

    def forgotten() -> None:
        rows[0] = rows[0][:0].copy()

    memory = WordMemory(work, 200_000, keep=False, forgotten=forgotten)

    def predict(texts: Sequence[str | None]) -> list[tuple[str, float]]:
        cut = [(t or "").split() for t in texts]
        here = {w: k for k, w in enumerate(dict.fromkeys(chain.from_iterable(cut)))}    # a small table for the many look-ups
        known = memory.learn(here).__getitem__ if network.labels else None
        sums = rows[0][np.fromiter(map(known, here), np.int64, len(here))] if known else None
        out = []
        for words in cut:
            if known is None or not any(any(map(str.isalpha, w)) for w in words):
                out.append((UNKNOWN, 0.0))
                continue
            total = sums[np.fromiter(map(here.__getitem__, words), np.int64, len(words))].sum(axis=0)
            best = int(np.argmax(total[:-1]))
            out.append((network.labels[best], float(min(1.0, total[best] / total[-1]))))
        return out

    return predict


_PREDICTORS: dict[tuple[str, bool], Callable[[Sequence[str | None]], list[tuple[str, float]]]] = {}


def process_predictor(network: Network, evidence: bool = False) -> Callable[[Sequence[str | None]], list[tuple[str, float]]]:
    """The process's predictor for these weights: what it has learned serves later tasks."""
    name = network.digest(), evidence
    if name not in _PREDICTORS:
        _PREDICTORS.clear()
        _PREDICTORS[name] = predictor(network, evidence)
    return _PREDICTORS[name]


def with_language(docs: DataFrame, network: Network, text_col: str = "text", label: str = "lang_pred", score: str = "score",
                  evidence: bool = False) -> DataFrame:
    """``docs`` with the predicted language and its score (0 to 1).

    The network reads a text word by word (runs without white space, long ones in
    parts of 40 bytes), from both ends of the word, and gives every byte a chance
    of each language; the score is the mean over all bytes of the text.  Null
    text, empty text and text without a letter is ``und`` with score 0, as is all
    text if the network knows no language.  With ``evidence`` words without a letter
    and unknown characters count as equal chances of all languages.  Equal texts get equal results;
    a text is read whole, however long.  Rows are neither moved nor dropped, an empty
    table stays empty; other columns pass through, but one named like a
    new one, in whatever case, gives way to it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {label.lower(), score.lower()}])
    at = docs.columns.index(text_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = process_predictor(network, evidence)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                found = predict(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    [*part.schema.names, label, score])

    schema = docs.schema
    return docs.mapInArrow(read, type(schema)([*schema.fields]).add(label, "string").add(score, "double"))


def lot_of(key: Column, lots: int) -> Column:
    """The part of ``lots`` that a row falls into by the checksum of its id as text."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % lots
