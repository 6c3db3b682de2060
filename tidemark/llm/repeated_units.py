"""Lines, and sentences inside lines, that occur earlier in the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.distinct_words import release
from tidemark.llm.store import stored
from tidemark.session import with_settings

LEAST_WORDS = 5
#: A unit also counts with this many characters of scripts that are written without spaces.
LEAST_UNSPACED = 15
#: Texts of a batch that are taken apart at a time, which bounds what their units hold.
SLICE = 512
#: Bytes of a batch on its way to Python while units are looked for: both sides hold a batch, its buffers and copies of them.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}
_SENTENCE_END = re.compile(r"(?<=[.!?。！？…])\s+|(?<=[。！？])(?=\S)")
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\U00020000-\U0003ffff]")


def _counts(words: list[str], least_words: int) -> bool:
    """Whether a unit is long enough to be compared."""
    return len(words) >= least_words or sum(len(_UNSPACED.findall(w)) for w in words if not w.isascii()) >= LEAST_UNSPACED


def units(text: str | None, least_words: int = LEAST_WORDS) -> Iterator[tuple[int, int, int, str]]:
    """``(first, last, line, normal text)`` of each unit, as character offsets (end excluded).

    Units are the lines and their sentences, also where a line is one sentence;
    ``line`` is 1 for a line and 0 for a sentence.  The normal text is in lower case with
    single spaces.  Units of fewer words are left out, unless they have enough characters
    of a script without spaces; a sentence there ends with its full stop.
    """
    at = 0
    for line in (text or "").split("\n"):
        words = line.lower().split()
        if _counts(words, least_words):
            yield at, at + len(line), 1, " ".join(words)
            ends = [m.span() for m in _SENTENCE_END.finditer(line)]
            for a, b in zip([0, *(e[1] for e in ends)], [*(e[0] for e in ends), len(line)], strict=True):
                words = line[a:b].lower().split()
                if _counts(words, least_words):
                    yield at + a, at + b, 0, " ".join(words)
        at += len(line) + 1


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
                    spans: str = "removed") -> DataFrame:
    """``docs`` with repeated units cut out of the text and ``removed``, their ``(first, last)`` offsets in the original text.

    A unit's digest is compared with those of all units of its kind; the
    occurrence with the least (id, text digest, offset) stays, all later ones go,
    within a document too.  A line of one sentence is compared as a line and as a
    sentence, so it meets its copy inside a longer line.  A line goes with its line
    break; a sentence within one leaves the space around it.  Lines and sentences of fewer
    than five words, and of fewer than 15 characters of a script without spaces, never go.

    Null text stays null and empty text empty; a text whose units all go becomes
    empty, its row stays.  A null id ranks after all others.  Rows that share id
    and text count as one document and keep the same units.  A text is read whole,
    however long; an empty table stays empty.  Other columns pass through, whatever
    their names, but one named like ``removed``, in whatever case, gives way to it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == spans.lower()])
    names = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for whole in batches:
            for batch in (whole.slice(k, SLICE) for k in range(0, whole.num_rows, SLICE)):
                rows, high, low, first, last = [], [], [], [], []
                for k, text in enumerate(batch.column(2)):
                    for a, b, kind, normal in units(text.as_py(), least_words):
                        name = xxhash.xxh3_128_intdigest(normal.encode("utf-8", "surrogatepass"), kind)
                        rows.append(k)
                        high.append((name >> 64) - 2**63)
                        low.append((name & (2**64 - 1)) - 2**63)
                        first.append(a)
                        last.append(b)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                     pa.array(first, pa.int32()), pa.array(last, pa.int32())],
                    ["id", "digest", "high", "low", "first", "last"])
        pa.default_memory_pool().release_unused()               # an idle worker holds nothing of its last task

    kind = docs.schema[id_col].dataType.simpleString()
    found = names.mapInArrow(cut, f"id {kind}, digest long, high long, low long, first int, last int")
    rank = F.struct(F.col("id").isNull().alias("unnamed"), "id", "digest", "first")
    with with_settings(docs.sparkSession, BATCH):
        repeated = stored(found.groupBy("high", "low").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("earliest"))
                          .where("n > 1").select("high", "low", "earliest"), "repeated")
        later = (found.join(repeated, ["high", "low"]).where(rank > F.col("earliest"))
                 .groupBy("id", "digest").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("cut")))
        later = stored(later, "cuts")
    others = [c for c in docs.columns if c != text_col]             # the text moves once, beside them
    whole = docs.select(F.struct(*others).alias("row"), F.col(id_col).alias("its_id"), F.xxhash64(text_col).alias("its_digest"), F.col(text_col).alias("its_text"))
    joined = whole.join(later, whole["its_id"].eqNullSafe(later["id"]) & (whole["its_digest"] == later["digest"]), "left")
    shorter = _shorter(F.when(F.col("cut").isNotNull(), F.col("its_text")), F.col("cut"))
    done = joined.select("row", "its_text", "cut", shorter.alias("shorter"))
    return done.select(
        *[F.when(F.col("cut").isNotNull(), F.col("shorter.text")).otherwise(F.col("its_text")).alias(c) if c == text_col else F.col("row").getField(c).alias(c)
          for c in docs.columns],
        F.when(F.col("cut").isNotNull(), F.col("shorter.spans")).otherwise(F.array().cast("array<struct<first:int,last:int>>")).alias(spans))


def _shorter(text: Column, cuts: Column) -> Column:
    """The text without the given units, and their spans; a sentence inside a line that goes is not listed again."""
    def without(whole: str, units_: list[dict]) -> dict:
        out, spans, at, parts = [], [], 0, sorted((u["first"], -u["last"]) for u in units_)
        for first, last in ((a, -b) for a, b in parts):
            if first < at:
                continue
            spans.append({"first": first, "last": last})
            out.append(whole[at:first])
            at = last
            if (first == 0 or whole[first - 1] == "\n") and (last == len(whole) or whole[last] == "\n"):
                # a whole line goes with the line break after it, or at the end the one before
                if at < len(whole):
                    at += 1
                elif out[-1].endswith("\n"):
                    out[-1] = out[-1][:-1]
        out.append(whole[at:])
        return {"text": "".join(out), "spans": spans}

    kind = pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])

    @F.arrow_udf("struct<text:string,spans:array<struct<first:int,last:int>>>")
    def cut(wholes: pa.Array, cuts_: pa.Array) -> pa.Array:
        done = [pa.array([], kind)]
        for k in range(0, len(wholes), SLICE):
            pairs = zip(wholes.slice(k, SLICE).to_pylist(), cuts_.slice(k, SLICE).to_pylist(), strict=True)
            done.append(pa.array([None if units_ is None else without(whole, units_) for whole, units_ in pairs], kind))
        return pa.concat_arrays(done)

    return cut(text, cuts)
