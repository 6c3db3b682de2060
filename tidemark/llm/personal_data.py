"""Personal data in texts: exact rules, and spans that boosted trees choose among many overlapping proposals.

The rules find what has a clear form.  Generators then propose every span that
might be personal data in another spelling or place (a number that runs into the
next one, ``name (at) host dot org``, a number without its plus sign).  Boosted
trees score proposals by their format and by what stands around them.  They learn
from the corpus itself: what the rules found is rewritten in its text into other
spellings (positive) and into look-alikes (negative).  Scores are calibrated on texts held out.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.distinct_words import release

KINDS = ("email", "ip", "card", "phone")
#: Texts that the trees are fitted on, of those with digits or an at sign and of all; and the most examples taken from them.
TEXTS, OTHER_TEXTS, EXAMPLES = 3000, 500, 60_000
#: The most true spans of a sampled text that are rewritten into examples.
SPANS_OF_A_TEXT = 50
#: Share of true spans among the chosen ones that a threshold has to reach on texts held out.
PRECISION = 0.99
#: Parts that the values of a feature are cut into.
PARTS = 32
Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """Whether a number passes the check of card numbers."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def small_parts(parts: Sequence[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def rule_matches(text: str) -> Iterator[tuple[Span, bool]]:
    """Leftmost non-overlapping matches of each kind's form, and whether they pass its check, in the order of kinds.

    Every form is found in time proportional to the text.
    """
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            done = host.end()
            yield (start, done, "email"), True
        at = text.find("@", at + 1)
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        yield (*m.span(), "ip"), small_parts(m.group().split("."))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group()) if m.end() - m.start() <= 37 else ""
        yield (*m.span(), "card"), 12 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield (*m.span(), "phone"), 9 <= len(_DIGIT.findall(m.group())) <= 15


def rule_spans(text: str | None) -> list[Span]:
    """The spans of the rules, by start, then kind."""
    return in_order(s for s, ok in rule_matches(text or "") if ok)


def in_order(spans: Iterator[Span] | Sequence[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


#: Joins that stand for an at sign or a dot.
_AT = re.compile(r"\s?(?:@|[(\[{]\s?at\s?[)\]}]|\sat(?=\s))\s?", re.IGNORECASE)
_DOTTED = re.compile(r"[A-Za-z0-9-]{1,63}(?:\s?(?:\.|[(\[{]\s?(?:dot|\.)\s?[)\]}]|\sdot(?=\s))\s?[A-Za-z0-9-]{1,63}){1,6}", re.IGNORECASE)
_NAME = re.compile(r"[A-Za-z0-9._%+-]{1,64}\Z")
_PARTED_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\s?(?:[.,:]|[(\[{]\.[)\]}]|\sdot\s)\s?[0-9]{1,3}){3}(?![0-9])", re.IGNORECASE)
_LONG_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_NUMBERS = re.compile(r"[0-9](?:[0-9 ().\-–/ ]*[0-9])?")
_GROUP = re.compile(r"[0-9]+")
#: The most groups of digits in a number.
GROUPS = 6


def proposals(text: str) -> Iterator[Span]:
    """Spans that might be personal data, overlapping ones too: many more than there are."""
    low = text.lower() if "at" in text or "At" in text or "AT" in text else text
    if "@" in low or " at " in low or "at)" in low or "at]" in low or "at}" in low or "at " in low:
        for m in _AT.finditer(text):
            name, host = _NAME.search(text, max(0, m.start() - 64), m.start()), _DOTTED.match(text, m.end())
            if name and host:
                yield name.start(), host.end(), "email"
    if not _DIGIT.search(text):
        return
    for pattern in (_PARTED_IP, _LONG_IP):
        for m in pattern.finditer(text):
            yield *m.span(), "ip"
    for run in _NUMBERS.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        for i, (start, _) in enumerate(groups):
            digits = 0
            for j in range(i, min(len(groups), i + GROUPS)):
                end = groups[j][1]
                digits += end - groups[j][0]
                if digits > 19:
                    break
                if digits < 7 or digits < 2 * (j - i + 1):
                    continue
                if digits >= 12:
                    yield start, end, "card"
                if digits <= 15:
                    lead = start
                    while lead and text[lead - 1] in "(+" and start - lead < 2:
                        lead -= 1
                    yield lead, end, "phone"


#: Words that often stand before each kind, and before other numbers.
BEFORE = {
    "email": ("mail", "email", "e-mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse", "client", "from"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta", "pan"),
    "phone": ("call", "tel", "phone", "fax", "mobile", "telefon", "téléphone", "teléfono", "handy"),
}
OTHERS = ("order", "id", "version", "token", "page", "isbn", "serial", "nr", "no", "code", "invoice", "date")
_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_SIDES = {c: k for k, chars in enumerate(('"\'`', "=#:/\\", "([{<", ")]}>", ".,;!?", "+-_*%$€£@&")) for c in chars}


def _side(text: str, at: int) -> int:
    """The kind of the character at a place: none, digit, letter, white space, or one of several marks."""
    if not 0 <= at < len(text):
        return 0
    c = text[at]
    return 1 if c.isdigit() else 2 if c.isalpha() else 3 if c.isspace() else 4 + _SIDES.get(c, 6)


def features(text: str, span: Span) -> tuple[float, ...]:
    """Numbers about the format of a span and about what stands around it; the order is fixed."""
    start, end, kind = span
    body = text[start:end]
    groups = _GROUP.findall(body)
    digits, sizes = "".join(groups), [len(g) for g in groups] or [0]
    joins = re.sub("[0-9A-Za-z]", "", body)
    labels = re.split(r"[^A-Za-z0-9-]+", body)
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    words = [w.lower() for w in _WORDS.findall(before)][-3:]
    return (
        len(body), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1], len(joins), len(set(joins)),
        sum(c.isspace() for c in body), body.count("."), body.count("@"), len(re.findall(r"[(\[{]", body)),
        float(12 <= len(digits) <= 19 and luhn(digits)), float(len(groups) == 4 and small_parts(groups)), len(set(digits)),
        int(digits[0]) if digits else -1, float(body.startswith("+")), float(body.startswith("(")), float(digits.startswith("00")),
        len(labels[-1]), float(labels[-1].isalpha()), float(labels[-1].islower()), len(labels), len(labels[0]),
        float(" dot " in body.lower()), float(" at " in body.lower()),
        _side(text, start - 1), _side(text, start - 2), _side(text, end), _side(text, end + 1),
        sum(c.isdigit() for c in before), sum(c.isdigit() for c in after),
        float(any(w in BEFORE[kind] for w in words)), float(any(w in OTHERS for w in words)),
        float(any(w in v for k, v in BEFORE.items() if k != kind for w in words)),
    )


class Trees:
    """Boosted regression trees of fixed depth for the log-loss, on features cut into parts at their quantiles."""

    def __init__(self, rounds: int = 50, depth: int = 3, rate: float = 0.25, ridge: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.ridge = rounds, depth, rate, ridge
        self.start, self.grown = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        self.grown = []
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.start = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, PARTS + 1)[1:-1])) for f in range(x.shape[1])]
        cut = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        cell = cut + PARTS * np.arange(len(edges))           # number of a feature's part among the parts of all
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            slope, bend = p - y, np.maximum(p * (1 - p), 1e-6)
            node, tree = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                feature, part = self._splits(cell, len(edges), slope, bend, node, 2**level)
                tree.append((feature.tolist(), [float(edges[f][k]) if k < len(edges[f]) else np.inf for f, k in zip(feature, part, strict=True)]))
                node = 2 * node + (cut[np.arange(len(y)), feature[node]] > part[node])
            total, weight = np.bincount(node, slope, 2**self.depth), np.bincount(node, bend, 2**self.depth)
            leaves = -self.rate * total / (weight + self.ridge)
            margin += leaves[node]
            self.grown.append((tree, leaves.tolist()))
        return self

    def _splits(self, cell: np.ndarray, width: int, slope: np.ndarray, bend: np.ndarray, node: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """Feature and part after which each node is split; a node without gain sends all rows left."""
        at = (cell + (node * width * PARTS)[:, None]).ravel()
        s, b = (np.cumsum(np.bincount(at, np.repeat(v, width), nodes * width * PARTS).reshape(nodes, width, PARTS), axis=2) for v in (slope, bend))
        all_s, all_b = s[:, :1, -1:], b[:, :1, -1:]
        gain = (s * s / (b + self.ridge) + (all_s - s)**2 / (all_b - b + self.ridge) - all_s**2 / (all_b + self.ridge)).reshape(nodes, -1)
        best = np.argmax(gain, axis=1)
        some = gain[np.arange(nodes), best] > 1e-9
        return np.where(some, best // PARTS, 0), np.where(some, best % PARTS, PARTS)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for tree, leaves in self.grown:
            node = np.zeros(len(x), np.int64)
            for feature, edge in tree:
                node = 2 * node + (x[rows, np.array(feature)[node]] > np.array(edge)[node])
            out += np.array(leaves)[node]
        return out


def calibrated(margins: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Rising steps of the share of true ones by margin (pooled neighbours): the steps' least margins, and their shares."""
    order = np.argsort(margins, kind="stable")
    blocks: list[list[float]] = []                       # least margin, true ones, all
    for m, v in zip(margins[order].tolist(), y[order].tolist(), strict=True):
        if blocks and blocks[-1][3] == m:
            blocks[-1][1] += v
            blocks[-1][2] += 1
        else:
            blocks.append([m, v, 1.0, m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], blocks[-1][1] + last[1], blocks[-1][2] + last[2], last[3]]
    return [b[0] for b in blocks], [b[1] / b[2] for b in blocks]


@dataclass
class Chooser:
    """For each kind the trees, the calibration and the least chance of a chosen span; a kind may be absent."""

    kinds: dict[str, tuple[Trees, list[float], list[float], float]]

    def chances(self, kind: str, x: np.ndarray) -> np.ndarray:
        trees, steps, shares, _ = self.kinds[kind]
        return np.array(shares)[np.maximum(np.searchsorted(steps, trees.margins(x), side="right") - 1, 0)]

    def chosen(self, texts: Sequence[str | None]) -> list[list[tuple[int, int, str, float]]]:
        """For each text the spans beyond those of the rules: likely ones, the likeliest of overlapping ones."""
        found: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
        open_: dict[str, list[tuple[int, Span, tuple[float, ...]]]] = {k: [] for k in self.kinds}
        for k, text in enumerate(texts):
            if text:
                taken = Taken(rule_spans(text))
                for span in set(proposals(text)):
                    if span[2] in open_ and not taken.meets(span):
                        open_[span[2]].append((k, span, features(text, span)))
        for kind, rows in open_.items():
            if rows:
                least = self.kinds[kind][3]
                for (k, span, _), chance in zip(rows, self.chances(kind, np.array([r[2] for r in rows])).tolist(), strict=True):
                    if chance >= least:
                        found[k].append((*span, chance))
        return [_apart(f) for f in found]


class Taken:
    """Spans in order of their starts, for questions about overlap."""

    def __init__(self, spans: Sequence[Span]) -> None:
        self.starts, self.ends, far = [], [], 0
        for a, b, _ in sorted(spans):
            far = max(far, b)
            self.starts.append(a)
            self.ends.append(far)                        # the farthest end up to here

    def meets(self, span: Span) -> bool:
        at = bisect_left(self.starts, span[1])
        return at > 0 and self.ends[at - 1] > span[0]


def _apart(found: list[tuple[int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """The likeliest of overlapping spans; among equals the longest, then the first."""
    kept, starts = [], []
    for span in sorted(found, key=lambda s: (-s[3], s[0] - s[1], s[0], KINDS.index(s[2]))):
        at = bisect_left(starts, (span[1],))
        if at and starts[at - 1][1] > span[0]:
            continue
        starts.insert(at, (span[0], span[1]))
        kept.append(span)
    return sorted(kept, key=lambda s: (s[0], KINDS.index(s[2])))


#: Last labels of host names in rewritten examples.
ENDS = ("com", "org", "net", "edu", "de", "fr", "es", "info", "io", "eu")


def _word(lot: random.Random) -> str:
    return "".join(lot.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(lot.randrange(2, 10)))


def _other_spelling(kind: str, body: str, lot: random.Random) -> str:
    """The same kind of data in a spelling that the rules do not take."""
    if kind == "email":
        at, dot = lot.choice(((" (at) ", "."), ("[at]", "[dot]"), (" at ", " dot "), ("(at)", "(dot)"), (" @ ", "."), (" [at] ", " [dot] ")))
        name, host = body.rsplit("@", 1) if lot.random() < 0.4 else (_word(lot) + lot.choice(("", f".{_word(lot)}", f"{lot.randrange(1000)}", f"_{_word(lot)}")),
                                                                     ".".join([*(_word(lot) for _ in range(lot.randrange(1, 3))), lot.choice(ENDS)]))
        return name + at + host.replace(".", dot)
    if kind == "ip":
        return body.replace(".", lot.choice(("[.]", "(.)", " . ", " dot ", ",")) if lot.random() < 0.8 else ".", lot.choice((-1, 3)))
    digits = re.sub("[^0-9]", "", body)
    if kind == "card":
        join = lot.choice((".", "/", "–", " ", "  ", ""))
        return join.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    rest = digits[-10:]
    form = lot.choice(("({}) {}-{}", "00{} {} {}", "{}-{}-{}", "{}.{}.{}", "{} {} {}", "0{}/{}{}"))
    return form.format(rest[:3], rest[3:6], rest[6:])


def _look_alike(kind: str, body: str, lot: random.Random) -> str:
    """Something of a similar form that is no personal data."""
    digits = re.sub("[^0-9]", "", body) or "1234567"
    if kind == "email":
        words = [_word(lot) for _ in range(3)] if lot.random() < 0.5 else re.findall("[A-Za-z]+", body)[:3] or ["a", "b"]
        return lot.choice(("{} at {}. {}", "{} at {}", "{} @ {}", "@{} {} {}")).format(*(words * 3)[:3])
    if kind == "ip":
        parts = [str(lot.choice((256, 300, 512, 777, 999)) if lot.random() < 0.5 else lot.randrange(1000)) for _ in range(4)]
        parts[lot.randrange(4)] = str(lot.randrange(256, 1000))
        return lot.choice((".", ", ", ",", "[.]", ":")).join(parts)
    if kind != "ip" and lot.random() < 0.25:             # part of a key
        return "".join(lot.choice("0123456789abcdef" if lot.random() < 0.5 else "0123456789") for _ in range(lot.randrange(16, 41))) + "e"
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + lot.randrange(1, 10)) % 10)
        join = lot.choice(("", "", " ", "-", ".", "/"))
        return join.join(wrong[k:k + 4] for k in range(0, len(wrong), 4))
    return lot.choice(("{y}-{m:02d}-{d:02d} {h:02d}", "{d:02d}.{m:02d}.{y}", "{y}/{m:02d}/{d:02d}", "{a} {b:03d} {b:03d}", "{a}.{b:03d}.{b:03d}",
                       "{y} - {z}", "{a}{b:03d}{b:03d}", "{a}{b:03d}{b:03d}{b:03d}{h:02d}{h:02d}{h:02d}{h:02d}{h:02d}{h:02d}")).format(
        y=lot.randrange(1900, 2040), z=lot.randrange(1900, 2040), m=lot.randrange(1, 13), d=lot.randrange(1, 29), h=lot.randrange(24),
        a=lot.randrange(1, 1000), b=lot.randrange(1000))


def examples(text: str, lot: random.Random) -> Iterator[tuple[str, tuple[float, ...], int]]:
    """``(kind, features, label)`` from one text and from rewritten surroundings of what the rules find in it.

    Proposals that equal a true span are positive, other ones negative.  A proposal
    inside something of a rule's form that failed its check tells nothing.
    """
    matches = list(rule_matches(text))
    true, failed = [s for s, ok in matches if ok], Taken([s for s, ok in matches if not ok])
    yield from _labelled(text, set(true), failed)
    for start, end, kind in true if len(true) <= SPANS_OF_A_TEXT else lot.sample(true, SPANS_OF_A_TEXT):
        before, after = text[max(0, start - 60):start], text[end:end + 60]
        for _ in range(4):
            way, body = lot.random(), text[start:end]
            lead = "" if lot.random() < 0.5 else lot.choice(BEFORE[kind] if way < 0.6 else OTHERS) + lot.choice((" ", ": ", " = "))
            if way < 0.4:
                body, label = _other_spelling(kind, body, lot), True
            elif way < 0.6:                              # one true span beside another number
                body, label = body, True
                after = " " + text[start:end] + after if lot.random() < 0.5 else f" {lot.randrange(10**lot.randrange(1, 17))}{after}"
            else:
                body, label = _look_alike(kind, body, lot), False
            whole, at = before + lead + body + after, len(before) + len(lead)
            here = {s for s in _inside(whole, at, at + len(body)) if label}
            rest = [s for s, _ in rule_matches(whole) if not (s[0] < at + len(body) and s[1] > at)]
            yield from _labelled(whole, {(at, at + len(body), kind)} if label else here, Taken(rest), (at, at + len(body)))


def _inside(text: str, start: int, end: int) -> list[Span]:
    return [s for s in proposals(text) if s[0] >= start and s[1] <= end]


def _labelled(text: str, true: set[Span], unknown: Taken, only: tuple[int, int] | None = None) -> Iterator[tuple[str, tuple[float, ...], int]]:
    addresses = Taken([s for s in true if s[2] == "ip"])           # numbers inside one are not told apart
    for span in set(proposals(text)):
        if only and not (span[0] < only[1] and span[1] > only[0]):
            continue
        if span in true:
            yield span[2], features(text, span), 1
        elif not unknown.meets(span) and (span[2] == "ip" or not addresses.meets(span)):
            yield span[2], features(text, span), 0


def fit_chooser(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: int = TEXTS, others: int = OTHER_TEXTS,
                most: int = EXAMPLES, precision: float = PRECISION) -> Chooser:
    """Trees and thresholds from a bounded sample of texts, chosen by the hash of their ids.

    A third of the sampled texts teaches nothing; on these the chances are
    calibrated and the thresholds set: the least chance at which ``precision`` of the
    chosen proposals are true.  A kind without true spans among the texts of
    either part is absent.  Rows with a null id or text teach nothing.
    """
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    order = F.xxhash64("id", F.lit(12)), F.col("id")
    ids = {r.id for r in rows.where(F.col("text").rlike("@|[0-9]{3}|[0-9][.][0-9]")).select("id").orderBy(*order).limit(texts).collect()}
    ids |= {r.id for r in rows.select("id").orderBy(*order).limit(others).collect()}          # both bounded by parameters
    sample = rows.where(F.col("id").isin(sorted(ids))) if ids else rows.where(F.lit(False))

    def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass"))
                found = sorted(examples(text, random.Random(seed)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in found], pa.string()), pa.array([seed % 3 == 0] * len(found), pa.bool_()),
                     pa.array([list(x) for _, x, _ in found], pa.list_(pa.float64())), pa.array([y for _, _, y in found], pa.int32())],
                    ["kind", "held", "x", "y"])

    found = sample.mapInArrow(teach, "kind string, held boolean, x array<double>, y int")
    taught = found.orderBy(F.xxhash64("x", "y"), "kind", "x", "y").limit(most).collect()       # at most ``most`` rows of features
    kinds = {}
    for kind in KINDS:
        x = np.array([r.x for r in taught if r.kind == kind], np.float64)
        y = np.array([r.y for r in taught if r.kind == kind], np.float64)
        held = np.array([r.held for r in taught if r.kind == kind], bool)
        if not len(y) or not y[~held].any() or not y[held].any():
            continue
        trees = Trees().fit(x[~held], y[~held])
        margins = trees.margins(x[held])
        steps, shares = calibrated(margins, y[held])
        chance = np.array(shares)[np.maximum(np.searchsorted(steps, margins, side="right") - 1, 0)]
        for least in sorted(set(shares)):
            some = chance >= least
            if least >= 0.5 and some.any() and y[held][some].mean() >= precision:
                kinds[kind] = trees, steps, shares, least
                break
    return Chooser(kinds)


FOUND = "struct<base:array<struct<kind:string,start:int,end:int>>,added:array<struct<kind:string,start:int,end:int,chance:double>>>"


def with_personal_data(docs: DataFrame, chooser: Chooser, text_col: str = "text", found: str = "personal", redacted: str | None = None) -> DataFrame:
    """``docs`` with ``found (base, added)``: spans in code points, end excluded, of the rules and of the trees.

    ``added`` spans overlap neither each other nor those of the rules, which may
    overlap each other where their kinds differ.  With ``redacted`` a column of that
    name holds the text with every span replaced by its kind in brackets.  Null and
    empty texts have no spans; a null text stays null.  Texts are read whole, in time
    proportional to their length.  Equal texts get equal spans.  Rows are
    neither moved nor dropped; an empty table stays empty; other columns pass
    through, and one that is named like a new one, in whatever case, gives way to it.
    """
    new = [c for c in (found, redacted) if c]
    kept = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in new}])
    at, extra = kept.columns.index(text_col), pa.struct(
        [("base", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
         ("added", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("chance", pa.float64())])))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                texts = part.column(at).to_pylist()
                rows = [{"base": [{"kind": c, "start": a, "end": b} for a, b, c in rule_spans(t)],
                         "added": [{"kind": c, "start": a, "end": b, "chance": p} for a, b, c, p in more]}
                        for t, more in zip(texts, chooser.chosen(texts), strict=True)]
                columns = [*part.columns, pa.array(rows, extra)]
                if redacted:
                    columns.append(pa.array([_without(t, [*r["base"], *r["added"]]) for t, r in zip(texts, rows, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *new])

    names = T.StructType.fromDDL(f"found {FOUND}").fields[0].dataType
    schema = T.StructType([*kept.schema.fields]).add(found, names)
    return kept.mapInArrow(read, schema.add(redacted, "string") if redacted else schema)


def _without(text: str | None, spans: Sequence[dict]) -> str | None:
    """The text with its spans replaced; spans that overlap go as one, under the first one's kind."""
    if text is None:
        return None
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= at:
            out += [text[at:s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, by start, then kind as listed, joined by commas."""
    place = F.lit(",".join(KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.find_in_set(s["kind"], place).alias("place"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
