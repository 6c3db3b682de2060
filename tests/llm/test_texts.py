"""Shards, token files, decontamination, chats and pieces: against the plain statement of each."""

from __future__ import annotations

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import by_id, docs_of, folder  # noqa: F401
from tidemark.llm import chat
from tidemark.llm.decontaminate import BITS, Benchmark, contaminated, hits
from tidemark.llm.pieces import Codec, coded, viterbi
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.sharding import jump, sharded
from tidemark.llm.token_files import byte_bpe, open_ids, read_tokens, token_digests, write_tokens

ODD = ["", " ", "  a  b\n\n c \t  x", "it's we'll 12 345 Ⅷ½²", "日本語 🎉🎉 é", "<|endoftext|> a<|endoftext|>", "a\r\n b\x00\x01", "\u200bx\u3000y\u00a0 z",
       "don't'S 'S", "x" * 3000 + " " * 50 + "1" * 40, "end \n", "\n start", "a \n \n b", "▁ under ▁"]


def plain_jump(key, n):
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
    return b


def test_jump_equals_the_loop():
    keys = np.random.default_rng(1).integers(0, 2**64, 2000, dtype=np.uint64)
    for n in (1, 2, 40, 41, 1000):
        assert jump(keys, n).tolist() == [plain_jump(int(k), n) for k in keys]
    assert set(np.flatnonzero(jump(keys, 40) != jump(keys, 41))) == set(np.flatnonzero(jump(keys, 41) == 40))


def test_shards(docs_of):
    docs = [(k, f"text {k % 5}") for k in range(500)] + [(7, "again"), (7, "again"), (None, None), (None, "ü"), (600, "")]
    rows = sharded(docs_of(docs).repartition(7), 40).collect()
    assert len(rows) == len(docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in docs)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1 == len({r.shard for r in rows if r.doc_id is None})
    assert all(r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40 for r in rows)
    assert sharded(docs_of([(1, "a")]).where("false"), 40).count() == 0


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_words_give_the_ids_of_the_text():
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab \n\t.,'s1é🎉") for _ in range(60)) for _ in range(300)]
    t, encode = tokenizer(), byte_bpe(tokenizer_file("byte_bpe_50k.json"), "<u2")
    assert [np.frombuffer(i, "<u2").tolist() for i in encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_a_piece_is_merged_once_for_all_words_that_hold_it(monkeypatch):
    """Words that differ in the marks around them took the model's work again for each of them."""
    import tokenizers

    path, calls = tokenizer_file("byte_bpe_50k.json"), []

    class Counted:
        def __init__(self, whole):
            self.tokenize = lambda piece: calls.append(piece) or whole.model.tokenize(piece)

    class Library:
        def __init__(self, whole):
            self.model, self.get_added_tokens_decoder = Counted(whole), whole.get_added_tokens_decoder

        @staticmethod
        def from_file(name):
            return Library(found)

    found, t = tokenizers.Tokenizer.from_file(path), tokenizer()
    monkeypatch.setattr(tokenizers, "Tokenizer", Library)
    texts = ["a word, a word. (word) word! word", " word?", "word  word\n word ", ""]
    assert [np.frombuffer(i, "<u2").tolist() for i in byte_bpe(path, "<u2")(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(calls) == len(set(calls))


def same_ids_as_the_library(texts):
    t, encode = tokenizer(), byte_bpe(tokenizer_file("byte_bpe_50k.json"), "<u2")
    assert [np.frombuffer(i, "<u2").tolist() for i in encode(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_pieces_are_remembered_and_not_words():
    """Each spelling of a word with the marks around it was cut and kept: over the budget of CPU seconds where words seldom recur."""
    from tidemark.llm import distinct_words

    marks = ["", ".", ",", "!", "?", "(", ")", ";"]
    same_ids_as_the_library([" ".join(a + word + b for a in marks for b in marks) for word in ("one", "two", "three")])
    assert len(distinct_words._HELD[0].found) <= 2 * 3 + 2 * len(marks) ** 2 // 2       # words and marks, with and without a space


def test_characters_are_of_the_kinds_that_the_library_knows():
    """Letters newer than the library's tables were taken for letters."""
    new = "\u088f\u0c5c\ua7ce\ua7d2"
    same_ids_as_the_library([f"a{c}1{c}!{c} {c}{c}b '{c}s{c}'s \n{c}" for c in new + "\u0558\u2028\u3000\x85\x1cé½日🎉\u0301"])


def test_texts_in_a_row_are_cut_apart(monkeypatch):
    same_ids_as_the_library(["don'", "t", "a ", " b", "'", "s", "", "x\u3000", "\u3000", "y", "'l", "l", " ", "\n", "'ve", "'", "re's'd'lls", " 's", "1'm", ""])
    monkeypatch.setattr("tidemark.llm.token_files.STRETCH", 16)
    same_ids_as_the_library(["some words é it's   \n 12, " * 20, "x" * 50, " " * 50, "", *ODD])


def test_added_tokens_as_the_library_takes_them(docs_of, spark, tmp_path):
    """The query's ids are those of a tokenizer with default settings."""
    from tidemark.llm.queries import op2_token_files
    from tokenizers import Tokenizer

    t, texts = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")), [*ODD, "a <|endoftext|> b"]
    want = {k: zlib.crc32(np.array([*t.encode(x, add_special_tokens=False).ids, 0], "<u4").tobytes()) for k, x in enumerate(texts)}
    docs_of(texts).write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.ids_crc32 for r in op2_token_files(spark, str(tmp_path)).collect()} == want


def test_token_files(docs_of, spark, folder, tmp_path):
    docs = [(k, t) for k, t in zip(random.Random(1).sample(range(900), 300), (ODD * 30)[:300], strict=True)] + [(1000, None), (1000, "tie")]
    t, path = tokenizer(), tokenizer_file("byte_bpe_50k.json")
    got = sorted((r.doc_id, r.n_tokens, r.ids_crc32, r.start) for r in token_digests(docs_of(docs), path, 0, 50_257).collect())
    want = [(k, [*t.encode(x or "", add_special_tokens=False).ids, 0]) for k, x in docs]
    assert Counter((k, n, c) for k, n, c, _ in got) == Counter((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in want)
    at = 0
    for _, n, _, start in sorted(got, key=lambda r: r[3]):
        assert start == at
        at += n
    assert [k for k, *_ in sorted(got, key=lambda r: r[3])] == sorted(k for k, _ in docs)
    manifest = write_tokens(docs_of(docs), str(tmp_path / "out"), lambda: byte_bpe(path, "<u2"), "<u2", 0)
    assert sum(f["documents"] for f in manifest) == 302 and isinstance(open_ids(str(tmp_path / "out"), manifest[0]["name"], "<u2"), np.memmap)
    none = write_tokens(docs_of(docs).where("false"), str(tmp_path / "none"), lambda: byte_bpe(path, "<u2"), "<u2", 0)
    assert none == [] and read_tokens(spark, str(tmp_path / "none")).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_hits(text, items):
    words = WORD.findall(lower(text))
    hit, names = [False] * len(words), []
    for name, item in items:
        own = WORD.findall(lower(item))
        occurs = False
        for k in range(max(1, len(own) - 9) if own else 0):
            w = own[k:k + 10]
            for at in range(len(words) - len(w) + 1):
                if words[at:at + len(w)] == w:
                    occurs, hit[at:at + len(w)] = True, [True] * len(w)
        if occurs:
            names.append(str(name))
    return len(words), sum(hit), sorted(names)


def bench_case():
    rng = random.Random(3)
    word = lambda: rng.choice(["the", "of", "a", "é1", "bb", "ccc", "Zz", "9"]) + str(rng.randrange(3))
    items = [(k, rng.choice([" ", ", ", "-"]).join(word() for _ in range(rng.choice([1, 3, 8, 10, 11, 14])))) for k in range(25)]
    items += [(90, None), (91, "..."), (92, items[20][1]), (93, items[21][1].upper()), (None, items[22][1])]
    docs = [" ".join(word() for _ in range(rng.randrange(0, 60))) for _ in range(60)]
    docs += [f"pre {items[k][1]} post" for k in range(25)] + [items[13][1] * 40, None, "", "!!", items[20][1][:-1], "a" * 200_000]
    return docs, items


def test_decontamination_equals_a_plain_search(docs_of, spark):
    docs, items = bench_case()
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("found", F.lit(1))
    found = by_id(contaminated(docs_of(docs), table).withColumn("n_hit", hits()))
    named = [(k, t) for k, t in items if k is not None]
    for k, text in enumerate(docs):
        n, hit, names = brute_hits(text, named)
        assert (found[k]["found"]["n_words"], found[k]["found"]["items"]) == (n, names)
        assert found[k]["n_hit"] == brute_hits(text, items)[1] >= hit


def test_decontamination_in_passes(docs_of, spark, monkeypatch):
    docs, items = bench_case()
    table = spark.createDataFrame(items, "item_id long, text string")
    once = contaminated(docs_of(docs), table).select("doc_id", "found").collect()
    monkeypatch.setattr("tidemark.llm.decontaminate.PASS_BYTES", 400)
    assert sorted(contaminated(docs_of(docs), table).select("doc_id", "found").collect()) == sorted(once)
    assert contaminated(docs_of(docs), table.where("false")).where("size(found.spans) > 0").count() == 0
    assert contaminated(docs_of(docs).where("false"), table).count() == 0
    assert sorted(contaminated(docs_of(docs).withColumn("Found", F.lit(1)), table).select("doc_id", "found").collect()) == sorted(once)


def test_tables_of_much_benchmark_text_are_bounded():
    """A pass of items in one process: tables of a few bytes for each byte of text."""
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(20_000)]
    items = [(str(k), " ".join(words[i] for i in rng.integers(0, len(words), 200))) for k in range(1500)]
    size = sum(len(t) for _, t in items)
    tracemalloc.start()
    bench = Benchmark(items)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert size > 1_500_000 and held - 2**BITS * 8 < 20 * size and most < 150 * size
    assert bench.scan(f"x {items[7][1]} y")[2] == ["7"]


def test_shifts_skip():
    searcher = Benchmark([(k, " ".join(f"word{k}x{i}" for i in range(12))) for k in range(20)]).searchers[-1]
    assert searcher.shift.mean() > 0.9 * (searcher.least - searcher.block + 1)


def chat_rows(spark):
    odd = "\\### Assistant: </turn> ok"
    rows = [(1, 1, "assistant", odd), (1, 0, "user", odd), (2, 0, "system", "a:\nb\\h \\\\b ####</turn</turn>>\n:\n</turn>\n### user:\n"),
            (2, 1, "assistant", None), (2, 2, "assistant", "日本🎉"), (3, None, None, None), (4, 0, "a:\n###", "x"), (4, 0, "a:\n###", "x"),
            (None, 0, "user", "lost"), (5, 0, "user", "long " * 30_000), (5, 1, "assistant", "\\" * 500)]
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit(1)).withColumn("piece", F.lit(2))


def test_chats_read_back(spark):
    rows, table = chat_rows(spark)
    out = chat.formatted(chat.table_turns(table, "conv_id"))
    got = by_id(out.select("*", chat.parsed_turns(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss")).alias("learned")),
                "conversation")
    assert len(got) == len({r[0] for r in rows})
    for key, r in got.items():
        own = sorted(((-1 if t is None else t, role or "", text or "") for k, t, role, text in rows if k == key))
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(role, text) for _, role, text in own]
        assert r["learned"] == "".join(text for _, role, text in own if role == "assistant")
    assert chat.formatted(chat.table_turns(table.where("false"), "conv_id")).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_layouts(spark):
    texts = ['{"messages":[{"role":"user","content":"hi"},{"content":"yo","role":"assistant"}],"n":[1]}',
             '{"messages":[{"role":"user","content":"hi"},{"content":"yo","role":"assistant"}]}',
             '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":null}]}', '{"prompt":"p","completion":"c"}',
             '{"output":"o","instruction":"i","input":""}', '{"instruction":"i","output":""}', "nope", None, "", "[]", "{}", '{"messages":[]}']
    table = spark.createDataFrame(list(enumerate(texts)), "id long, document string").withColumn("layouts", F.lit(1))
    got = {k: (r["layout"], [(t["role"], t["text"]) for t in r["turns"]]) for k, r in by_id(chat.turns_of(table), "id").items()}
    assert got[0] == (None, []) and got[1] == ("messages", [("user", "hi"), ("assistant", "yo")])
    assert got[2] == ("from_value", [("user", "q"), ("assistant", "")]) and got[3][1] == [("user", "p"), ("assistant", "c")]
    assert got[4] == ("instruction_input", [("user", "i"), ("assistant", "o")]) and got[5] == ("instruction", [("user", "i"), ("assistant", "")])
    assert all(got[k] == (None, []) for k in range(6, 12))
    turns = chat.document_turns(table, "id").collect()
    assert len(turns) == 10
    nested = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "id long, conversations array<struct<from:string,value:string>>")
    assert [(r.role, r.text) for r in chat.table_turns(nested, "id").orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    with pytest.raises(ValueError):
        chat.table_turns(spark.range(1).withColumn("other", F.lit(1)), "id")
    rows = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, None, None)], "id long, turn long, role string, text string")
    for extra in ([], ["prompt"], ["messages", "system"], ["instruction", "input", "Turn_"]):
        more = rows.select("*", *[F.lit("x").alias(c) for c in extra])
        assert sorted((r.turn, r.role, r.text) for r in chat.table_turns(more, "id").collect()) == [(0, "user", "q"), (1, "", "")]
    asked = spark.createDataFrame([(1, "i", "more", "o", "p")], "id long, instruction string, input string, output string, prompt string")
    assert [(r.role, r.text) for r in chat.table_turns(asked, "id").orderBy("turn").collect()] == [("user", "i"), ("user", "more"), ("assistant", "o")]
    as_rows = spark.createDataFrame([(1, '{"turn": 3, "role": "user", "text": null}')], "id long, document string")
    assert [(r.role, r.text) for r in chat.document_turns(as_rows, "id").collect()] == [("user", "")]


def slow_best(pieces, word):
    """Best segmentation by trying every piece at every place."""
    scores = dict(zip((pieces.strings[i] for i in pieces.ids), pieces.scores, strict=True))
    best = [(0.0, [])] + [None] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(max(0, end - pieces.longest), end):
            part = word[start:end]
            score = scores.get(part, pieces.unknown_score if end - start == 1 else None)
            if score is not None and (best[end] is None or best[start][0] + score > best[end][0]):
                best[end] = (best[start][0] + score, [*best[start][1], part])
    return [i for part in best[-1][1] for i in ([pieces.strings.index(part)] if part in scores else [pieces.byte_id[b] for b in part.encode()])]


@pytest.fixture(scope="module")
def codec():
    return Codec(tokenizer_file("piece_bpe_32k.model"))


def test_viterbi_equals_the_plain_search(codec):
    rng = random.Random(6)
    words = ["▁the", "▁theth", "日本語🎉", "▁▁▁a", "\x00"] + ["▁" * rng.randrange(2) + "".join(rng.choice("theraonsi▁é🎉z") for _ in range(rng.randrange(1, 22))) for _ in range(150)]
    assert viterbi(codec.pieces, words) == [slow_best(codec.pieces, w) for w in words]


def test_viterbi_equals_the_library_lattice(codec):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as source:
        model.ParseFromString(source.read())
    model.trainer_spec.model_type = 1                              # the same pieces and scores, searched for the best sum
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    for word in ["others", "theth", "Onhalyti", "ereslyan", "chüung", "ciónmente", "in"]:
        ids = np.frombuffer(codec.encode_all([word])[0], "<u4").tolist()
        assert [codec.pieces.strings[i] for i in ids] == library.NBestEncodeAsPieces(word, 2)[0]


def test_long_words_in_stretches(codec, monkeypatch):
    rng = random.Random(9)
    word = "▁" + "".join(rng.choice("theraonsi") for _ in range(700))
    whole = viterbi(codec.pieces, [word])
    monkeypatch.setattr("tidemark.llm.pieces.STRETCH", 64)
    assert viterbi(codec.pieces, [word]) == whole == [slow_best(codec.pieces, word)]


def test_pieces_decode_to_the_text(docs_of):
    texts = [None, *ODD, "word " * 20_000, "z" * 30_000]
    found = by_id(coded(docs_of(texts).withColumnRenamed("kept", "idz"), tokenizer_file("piece_bpe_32k.model")))
    assert {k: found[k]["decoded"] for k in found} == {k: (t or "").replace("▁", " ") for k, t in enumerate(texts)}
    assert found[0]["ids"] == found[1]["ids"] == b""
    assert coded(docs_of(texts).where("false"), tokenizer_file("piece_bpe_32k.model")).count() == 0


def test_units_are_looked_for_in_small_batches(docs_of, spark, monkeypatch):
    """Batches of the session's size, beside the sort of the units, took an executor beyond its memory."""
    from tidemark.llm import repeated_units

    key, held = "spark.sql.execution.arrow.maxBytesPerBatch", []
    before, stored = spark.conf.get(key, None), repeated_units.stored
    monkeypatch.setattr(repeated_units, "stored", lambda df, label: held.append(spark.conf.get(key)) or stored(df, label))
    line = "five words make a unit"
    found = repeated_units.without_repeats(docs_of([(1, line), (2, line), (3, None)]))
    assert {r.doc_id: r.text for r in found.collect()} == {1: line, 2: "", 3: None}
    assert held == [str(4 << 20)] * 2 and spark.conf.get(key, None) == before
