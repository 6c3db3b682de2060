"""Toxicity scores from a linear classifier that is fitted to ignore which group a text mentions."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.distinct_words import WordMemory
from tidemark.llm.store import stored

#: Mentions of groups, in English, French, German and Spanish; within a row any may stand for any other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "mother", "father"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrants", "refugees", "foreigners", "locals", "natives"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("femmes", "hommes", "filles", "garçons", "mères", "pères"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "bisexuels", "transgenres"),
    ("noirs", "blancs", "asiatiques", "arabes", "africains", "européens"),
    ("immigrés", "réfugiés", "étrangers", "migrants"),
    ("handicapés", "sourds", "aveugles", "vieux", "jeunes"),
    ("frauen", "männer", "mädchen", "jungen", "mütter", "väter"),
    ("muslime", "christen", "juden", "hinduisten", "buddhisten", "atheisten"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle", "transsexuelle"),
    ("schwarze", "weiße", "asiaten", "araber", "afrikaner", "europäer"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("behinderte", "gehörlose", "blinde", "alte", "junge"),
    ("mujeres", "hombres", "niñas", "niños", "madres", "padres"),
    ("musulmanes", "cristianos", "judíos", "hinduistas", "budistas", "ateos"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales", "transexuales"),
    ("negros", "blancos", "asiáticos", "árabes", "africanos", "europeos"),
    ("inmigrantes", "refugiados", "extranjeros", "lugareños"),
    ("discapacitados", "sordos", "ciegos", "mayores", "jóvenes"),
)
#: The most labelled texts of either class that the classifier is fitted on.
TEXTS_PER_CLASS = 2500
BITS = 20
_WORD = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> tuple[int, ...]:
    """Numbers of a word's features: the word, and its first four and five letters."""
    names = (f"w {word}", f"4 {word[:4]}", f"5 {word[:5]}")
    return tuple(xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) >> (64 - BITS) for n in names)


def words_of(text: str | None) -> set[str]:
    """The distinct runs of letters, in lower case."""
    return set(_WORD.findall((text or "").lower()))


Terms = Sequence[Sequence[str]]


def swapped(text: str, lot: int, terms: Terms = IDENTITY_TERMS) -> str | None:
    """The text with every identity term replaced by another one of its row; None if it has none."""
    found = False

    def other(match: re.Match) -> str:
        nonlocal found
        word = match.group().lower()
        for row in terms:
            if word in row:
                found = True
                return row[(row.index(word) + 1 + lot % (len(row) - 1)) % len(row)]
        return match.group()

    changed = _WORD.sub(other, text)
    return changed if found else None


def counterfactual(text: str, lot: int, terms: Terms = IDENTITY_TERMS) -> tuple[str, str]:
    """Two forms of a text that differ in the groups they name and should score alike.

    The text and its swapped form if it names a group, else the text with a mention
    of one group and with one of another group of the same row, which ``lot`` chooses.
    """
    other = swapped(text, lot, terms)
    if other is not None:
        return text, other
    row = terms[lot % len(terms)]
    one = lot // len(terms) % len(row)
    two = (one + 1 + lot // len(terms) // len(row) % (len(row) - 1)) % len(row)
    return f"{text}\n{row[one]}", f"{text}\n{row[two]}"


class Classifier:
    """Logistic regression on the presence of features: sparse weights, and equal scores for swapped texts.

    The loss is the (weighted) mean log-loss, plus ``sparse`` times the sum of absolute
    weights, plus ``fair`` times the mean squared difference of logits between the two
    forms of a text.
    """

    def __init__(self, fair: float = 30.0, sparse: float = 2e-4, steps: int = 300) -> None:
        self.fair, self.sparse, self.steps = fair, sparse, steps
        self.weights, self.bias = np.zeros(2**BITS), 0.0

    def fit(self, texts: Sequence[np.ndarray], labels: Sequence[int], pairs: Sequence[tuple[np.ndarray, np.ndarray]] = (),
            shares: Sequence[float] | None = None) -> Classifier:
        """Accelerated proximal steps over all texts; ``pairs`` holds the features of two forms of a text, ``shares`` what each text counts."""
        y = np.asarray(labels, np.float64)
        if not len(y) or y.min() == y.max():
            self.bias = 0.0 if not len(y) else float(np.log((y.mean() + 0.01) / (1.01 - y.mean())))
            return self
        share = np.full(len(y), 1 / len(y)) if shares is None else np.asarray(shares, np.float64) / np.sum(shares)
        x = _Rows(texts)
        more = [(np.setdiff1d(a, b), np.setdiff1d(b, a)) for a, b in pairs]
        lost, gained = _Rows([m[0] for m in more]), _Rows([m[1] for m in more])
        used = np.unique(np.concatenate([x.at, lost.at, gained.at]))          # all other weights stay 0
        for rows in (x, lost, gained):
            rows.number(used)
        w, bias, ahead, bias_ahead, pace = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0, 1.0
        step = 4.0 / (1 + x.spread(share) + 16 * self.fair * (lost.spread() + gained.spread()))
        for _ in range(self.steps):
            slope_of = (1 / (1 + np.exp(-(x.dot(ahead) + bias_ahead))) - y) * share
            slope = x.back(slope_of)
            if more:
                gap = 2 * self.fair * (lost.dot(ahead) - gained.dot(ahead)) / len(more)
                slope += lost.back(gap) - gained.back(gap)
            following = ahead - step * slope
            following = np.sign(following) * np.maximum(np.abs(following) - step * self.sparse, 0)
            bias_following = bias_ahead - step * slope_of.sum()
            pace_following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            push = (pace - 1) / pace_following
            ahead, bias_ahead = following + push * (following - w), bias_following + push * (bias_following - bias)
            w, bias, pace = following, bias_following, pace_following
        self.weights = np.zeros(2**BITS)
        self.weights[used], self.bias = w, float(bias)
        return self

    def scorer(self) -> Callable[[Sequence[str | None]], list[float]]:
        """Scores of texts; each distinct word is looked up once per memory."""
        weights = {int(k): float(self.weights[k]) for k in np.flatnonzero(self.weights)}

        def work(words: list[str]) -> list[tuple[int, ...]]:
            return [tuple(f for f in features_of(w) if f in weights) for w in words]

        memory = WordMemory(work, 400_000)

        def score(texts: Sequence[str | None]) -> list[float]:
            cut = [words_of(t) for t in texts]
            known = memory.learn(chain.from_iterable(cut)).__getitem__
            logits = [self.bias + sum(weights[f] for f in sorted(set(chain.from_iterable(map(known, words))))) for words in cut]
            return [float(1 / (1 + np.exp(-min(30.0, max(-30.0, z))))) for z in logits]

        return score


class _Rows:
    """Rows of feature numbers, end to end."""

    def __init__(self, rows: Sequence[np.ndarray]) -> None:
        self.at = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n, self.size = len(rows), 2**BITS

    def number(self, used: np.ndarray) -> None:
        """Count features by their place among the used ones."""
        self.at, self.size = np.searchsorted(used, self.at), len(used)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.at], self.n)

    def back(self, slopes: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, slopes[self.row], self.size)

    def spread(self, share: np.ndarray | None = None) -> float:
        """The greatest (weighted) mean squared logit of a unit weight vector, by power iteration."""
        v, size = np.ones(self.size), 0.0
        for _ in range(12 if self.n else 0):
            v = self.back(self.dot(v) * (1 / self.n if share is None else share))
            size = float(np.linalg.norm(v))
            v /= size or 1.0
        return size


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 texts: int = TEXTS_PER_CLASS, fair: float = 30.0, terms: Terms = IDENTITY_TERMS) -> Classifier:
    """A classifier fitted on at most ``texts`` labelled texts of either class, chosen by the hash of their ids.

    Each text has a counterfactual pair: itself and its swapped form where it names
    a group, else itself with the mention of one and of another group.  The first
    form is learned from, too, and the difference of the two scores is penalised.  Classes
    count as often as there are labelled texts of them, however many were chosen,
    so scores mean the same at every size of the table.

    Rows with a null label, other labels than 0 and 1, null ids and labels without
    a document teach nothing.  Features seen in fewer than three of the texts are
    left out, but for those of mentions.  Without texts of both classes the score is a constant.
    """
    named = (labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .groupBy("id").agg(F.max("label").alias("label")))
    owners = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    labelled = stored(named.join(owners, "id", "left_semi"), "labelled")
    all_ = dict(labelled.groupBy("label").count().collect())
    by_id = {r.id: r.label for label in all_
             for r in labelled.where(F.col("label") == label).orderBy(F.xxhash64("id", F.lit(11)), "id").limit(texts).collect()}   # at most ``texts`` each
    whole = (docs.where(F.col(id_col).isin(list(by_id))).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) if by_id
             else docs.where(F.lit(False)).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts_ = [t or "" for t in batch.column(1).to_pylist()]
            both = [counterfactual(t, xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")), terms) for t in texts_]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([_packed(t) for t in some], pa.binary()) for some in (texts_, [a for a, _ in both], [b for _, b in both])]],
                ["id", "own", "one", "two"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = sorted(whole.mapInArrow(extract, f"id {kind}, own binary, one binary, two binary").collect(), key=lambda r: (r.id, r.own))
    own, one, two = ([np.frombuffer(r[k], "<i4") for r in rows] for k in ("own", "one", "two"))
    seen = np.bincount(np.concatenate([*own, np.empty(0, np.int32)]).astype(np.int64), minlength=2**BITS) >= 3
    seen[[f for row in terms for w in row for f in features_of(w)]] = True
    label = [by_id[r.id] for r in rows]
    chosen = Counter(label)
    share = [all_[k] / chosen[k] for k in label]
    mentions = [k for k in range(len(rows)) if rows[k]["one"] != rows[k]["own"]]
    learned = [*own, *[one[k] for k in mentions]]
    return Classifier(fair).fit([o[seen[o]] for o in learned], [*label, *[label[k] for k in mentions]],
                                [(a[seen[a]], b[seen[b]]) for a, b in zip(one, two, strict=True)], [*share, *[share[k] for k in mentions]])


def _packed(text: str) -> bytes:
    return np.unique(np.fromiter(chain.from_iterable(map(features_of, words_of(text))), np.int64)).astype("<i4").tobytes()


_SCORERS: dict[str, Callable[[Sequence[str | None]], list[float]]] = {}


def _process_scorer(classifier: Classifier) -> Callable[[Sequence[str | None]], list[float]]:
    """The process's scorer for these weights: what it has learned serves later tasks."""
    name = xxhash.xxh3_128_hexdigest(classifier.weights.tobytes() + repr(classifier.bias).encode())
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = classifier.scorer()
    return _SCORERS[name]


def with_toxicity(docs: DataFrame, classifier: Classifier, text_col: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score (0 to 1) of the whole text.

    The score depends on which words occur, not on how often or where.  Null,
    empty and wordless texts get the score of a text without features; a text is
    read whole, however long.  Rows are neither moved nor dropped, an empty table stays
    empty; other columns pass through, but one named like the new one, in
    whatever case, gives way to it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == score.lower()])
    at = docs.columns.index(text_col)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scored = _process_scorer(classifier)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scored(part.column(at).to_pylist()), pa.float64())],
                                                 [*part.schema.names, score])

    schema = docs.schema
    return docs.mapInArrow(read, type(schema)([*schema.fields]).add(score, "double"))
