"""Token counts, BPE replay, packing and chat formatting against the libraries and plain versions."""

import hashlib
import random
import zlib
from array import array
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelspark.llm import bpe_replay, chat_format, packing, token_counts
from labelspark.llm.common import bpe_ranks
from labelspark.llm.tokens import Encoder, older_split

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = bpe_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def odd_texts(n=300):
    rng = random.Random(5)
    parts = ["a", "ab", " ", "  ", "\n", "\t", "'s", "'", "é", "ß", "日本", "1", "23", "<|endoftext|>", "<|endo", "!?", "\u00a0",
             "\u2003", "ᏸ", "\U0001f600", "re", "'ll", "\x1c", "\x85", "Ԧ", "\u0558"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)] + ["", "a" * 5000, " \n" * 3000]


def test_encoder_is_the_library(library):
    texts = odd_texts() + [" " * 12_000 + "x", "a" + "\n \t" * 700_000 + " b", "a" * 300_000]
    want = [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert Encoder(JSON).encode_batch(texts) == want
    # every character of the classes that are spelt out, between neighbours of each kind
    ranged = ["".join(f"a{c}b {c} 1{c}2 !{c}? {c}{c}x" for c in map(chr, range(lo, min(lo + 64, 0x530)))) for lo in range(0, 0x530, 64)]
    want = [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in ranged]
    assert Encoder(JSON).encode_batch(ranged) == want


def test_every_vocabulary_string_is_its_own_id(library):
    """Words are merged by ranks: that is the library's result only if merges lead to every string of the vocabulary."""
    from labelspark.llm.bpe_queue import vocabulary_of

    v, merge = vocabulary_of(JSON), Encoder(JSON).merge
    assert all(v.encode_word(text) == [i] for i, text in v.text.items() if i not in v.added.values())
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéß日 1!'") for _ in range(rng.randint(1, 30))).replace(" ", "") or "x" for _ in range(3000)]
    split = older_split().findall
    words = [w for t in words for w in split(t)]
    assert [merge(w) for w in words] == [e.ids for e in library.encode_batch_fast(words, add_special_tokens=False)]


@pytest.mark.parametrize("size,overlap", [(400, 150), (1 << 15, 1 << 10)])
def test_counts_are_the_library_s(spark, odd, docs, library, size, overlap):
    more = spark.createDataFrame([(-3, "abc<|endoftext|>" * 300 + "x"), (-4, "z" * 3000), (-5, "a b " * 900), (-6, " \n" * 1500),
                                  (-7, "héé " + "日本語テキスト" * 200 + " <|endoftext|> ok")], "doc_id long, text string")
    all_docs = odd.select("doc_id", "text").union(more).union(docs.select("doc_id", "text"))
    got = Counter(tuple(r) for r in token_counts.count_tokens(all_docs, size=size, overlap=overlap).collect())
    want = Counter()
    for i, t in all_docs.collect():
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[i, len((t or "").encode()), n, n > 1024] += 1
    assert got == want


def test_counts_of_nothing(no_docs):
    assert token_counts.count_tokens(no_docs).collect() == []
    with pytest.raises(ValueError):
        token_counts.count_tokens(no_docs, overlap=64)


def test_replay_is_tiktoken_s(tik):
    rng = random.Random(1)
    words = ["".join(rng.choice("abetionaaaé日ß") for _ in range(rng.randint(1, 40))) for _ in range(2000)] + ["a" * k for k in range(1, 60)]
    got = bpe_replay.replay([w.encode() for w in words], RANKS)
    assert got == [tik._core_bpe.encode_single_piece(w.encode()) for w in words]
    assert bpe_replay.replay([b"", b"a"], RANKS) == [[], [RANKS[b"a"]]]


def test_bpe_query(spark, odd, docs, no_docs, tik, monkeypatch):
    monkeypatch.setattr(bpe_replay, "MAX_WORDS", 50)
    more = spark.createDataFrame(list(enumerate(odd_texts(100), 10_000)), "doc_id long, text string")
    texts = odd.select("doc_id", "text").union(docs.select("doc_id", "text")).union(more)
    got = Counter(tuple(r) for r in bpe_replay.encode(texts, digests=True).collect())
    want, ids_of = Counter(), {}
    for i, t in texts.collect():
        ids = ids_of[i] = tik.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert got == want
    back = {r.doc_id: bytes(r.bytes) for r in bpe_replay.decode(bpe_replay.encode(more)).collect()}
    assert back == {i: t.encode() for i, t in more.collect()}
    assert bpe_replay.encode(no_docs).collect() == []


def test_packing_of_documents(odd, docs, no_docs, library):
    texts = docs.select("doc_id", "text").union(odd.select("doc_id", "text"))
    rows = packing.pack_documents(texts, with_ids=True).collect()
    want = Counter()
    for i, t in texts.collect():
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or min(2048, len(ids))
        starts = [0, *range(first, len(ids), 2048)]
        for p, (a, b) in enumerate(zip(starts, starts[1:] + [len(ids)])):
            want[i, p, a, b - a, zlib.crc32(array("I", ids[a:b]).tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= sum(r.length for r in rows) / 2048 * 1.02 + 1
    assert packing.pack_documents(no_docs).collect() == []


def test_packing_searches_on_three_islands(spark, monkeypatch):
    rng = random.Random(7)
    pieces = spark.createDataFrame([(i, rng.randint(26, 48)) for i in range(300)], "uid long, length long")
    seen, step = [], packing._step
    monkeypatch.setattr(packing, "_step", lambda rows, *a: seen.append(rows.select("block", "island").collect()) or step(rows, *a))
    packing.pack(pieces, capacity=100).collect()
    assert [sorted(map(tuple, x)) for x in seen] == [[(0, 0), (0, 1), (0, 2)]] * packing.EPOCHS


def test_packing_in_many_blocks_and_levels(spark):
    rng = random.Random(3)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(30, 70), 100]) for _ in range(2000)]
    pieces = spark.createDataFrame(list(enumerate(sizes)), "uid long, length long")
    got = packing.pack(pieces, capacity=100, block=150).collect()
    assert sorted(r.uid for r in got) == list(range(2000))
    load = Counter()
    for r in got:
        load[r.sequence_id] += sizes[r.uid]
    assert max(load.values()) <= 100
    single = packing.best_fit([], sorted(range(2000), key=lambda p: -sizes[p]), sizes, 100)
    assert len(load) <= 1.03 * len(single)


def test_crossover_keeps_every_piece():
    rng = random.Random(9)
    sizes = [rng.randint(1, 60) for _ in range(300)]
    a = packing.best_fit([], list(range(300)), sizes, 100)
    b = packing.best_fit([], sorted(range(300), key=lambda p: -sizes[p]), sizes, 100)
    for _ in range(20):
        child = packing.crossover(a, b, sizes, 100, rng)
        assert sorted(p for x in child for p in x) == list(range(300))
        assert max(sum(sizes[p] for p in x) for x in child) <= 100
        a, b = b, child


LAYOUTS = ['{"messages":[{"role":"user","content":"a\\\\ ### </turn>"},{"role":"assistant","content":"b\\n"}]}',
           '{"prompt":"p","response":"r"}', '{"conversations":[{"from":"human","value":"x"},{"from":"gpt","value":null}]}',
           '{"instruction":"i","input":"in","output":"o"}', '{"system":"s","prompt":"p","response":"\\\\h \\\\s\\\\t"}',
           '{"what":1}', "[1,2]", "not json", None]


def test_layouts_become_turns_and_read_back(spark):
    d = spark.createDataFrame(list(enumerate(LAYOUTS)), "conv_id long, j string").withColumn("record", F.try_parse_json("j"))
    got = {r.conv_id: r for r in chat_format.format_records(d).withColumn("back", chat_format.read_back(F.col("formatted"))).collect()}
    turns = {i: [tuple(t) for t in r.back] for i, r in got.items()}
    assert turns[0] == [("user", "a\\ ### </turn>"), ("assistant", "b\n")]
    assert turns[1] == [("user", "p"), ("assistant", "r")]
    assert turns[2] == [("user", "x"), ("assistant", "")]
    assert turns[3] == [("user", "i"), ("user", "in"), ("assistant", "o")]
    assert turns[4] == [("system", "s"), ("user", "p"), ("assistant", "\\h \\s\\t")]
    assert all(turns[i] == [] and got[i].n_unknown == 1 for i in (5, 6, 7, 8))
    for i, r in got.items():
        said = [r.formatted[s.start:s.stop] for s in r.loss_spans]
        assert len(said) == sum(role == "assistant" for role, _ in turns[i])


def test_turn_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, None, None, None), (2, 5, "us\ner\\n", "</turn>\n### x"),
            (2, 5, "us\ner\\n", "</turn>\n### x"), (None, 0, "user", "lost"), *((3, i, "assistant", f"t{i}") for i in range(200))]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    records = d.select("conv_id", "turn", F.to_variant_object(F.struct("role", "text")).alias("record"), F.lit("x").alias("turns"))
    done = chat_format.format_records(records, order_col="turn")
    got = {r.conv_id: r for r in done.withColumn("back", chat_format.read_back(F.col("formatted"))).collect()}
    assert [tuple(t) for t in got[1].back] == [("", ""), ("user", "a"), ("assistant", "b")]
    assert [tuple(t) for t in got[2].back] == [("us\ner\\n", "</turn>\n### x")] * 2
    assert [t.text for t in got[3].back] == [f"t{i}" for i in range(200)]
    assert [got[3].formatted[s.start:s.stop] for s in got[3].loss_spans] == [f"t{i}" for i in range(200)]
    assert len(got) == 4 and chat_format.digests(chat_format.format_records(records.limit(0), order_col="turn")).collect() == []


def test_fields_that_no_layout_declares_do_not_matter_and_unknown_records_come_back(spark):
    kept = ['{"prompt": "p", "response": "r", "id": 7, "meta": {"source": ["a", {"b": 1}]}}',
            '{"messages": [{"role": "user", "content": "p", "name": "n"}, {"role": "assistant", "content": "r", "w": [1]}]}',
            '{"role": "user", "text": null, "messages_": 1}', '{"system": null, "prompt": "p", "response": "r"}']
    lost = ['{"prompt": ["p"], "response": "r"}', '{"prompt": "p", "response": {"text": "r"}}',
            '{"messages": [{"role": "user", "content": [{"type": "text"}]}]}', '{"prompt": "p", "response": "r", "input": "i"}',
            '{"messages": ["p", {"role": "user", "content": "x"}]}', '{"messages": []}', '{}', '[1]', '3', 'null']
    d = spark.createDataFrame(list(enumerate(kept + lost)) + [(99, None)], "conv_id long, json string").withColumn(
        "record", F.parse_json("json"))
    got = {r.conv_id: [tuple(t) for t in r.back] for r in
           chat_format.format_records(d).withColumn("back", chat_format.read_back(F.col("formatted"))).collect()}
    assert got[0] == got[1] == [("user", "p"), ("assistant", "r")]
    assert got[2] == [("user", "")] and got[3] == [("system", ""), ("user", "p"), ("assistant", "r")]
    assert all(got[len(kept) + i] == [] for i in range(len(lost)))
    left = chat_format.unknown_records(d)
    assert left.columns == d.columns and {r.conv_id for r in left.select("conv_id").collect()} == {*range(4, 4 + len(lost)), 99}


def test_top_words_are_cut_on_a_histogram(spark):
    often, rare = " ".join(f"often{chr(97 + i)}" for i in range(26)), "\n".join(f"a{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26))
    texts = spark.createDataFrame([(i, often + "\n" + rare if i < 2 else often) for i in range(90)], "doc_id long, text string")
    full = bpe_replay.encoded_words(texts, "byte_bpe_50k.tiktoken", bpe_replay._pattern())
    few = bpe_replay.encoded_words(texts, "byte_bpe_50k.tiktoken", bpe_replay._pattern(), 326)
    assert len(full) > 676 and few.items() < full.items() and 226 < len(few) < 426
    assert {w for w in full if "often" in w} <= set(few)


def test_replay_looks_words_up_without_walking_the_table():
    """The table holds half a million words; a batch costs what its own words cost."""
    import public_tokenizers

    from labelspark.llm.bpe_replay import Coder

    class Table(dict):
        def keys(self):
            raise AssertionError("walked")

        __iter__ = items = values = keys

    plain = Coder("byte_bpe_50k.tiktoken", public_tokenizers.PATTERN, {})
    texts = ["the cat and the zyxqv cat", "", "the cat", "日本語 zyxqv zyxqv"]
    want = plain.encode_batch(texts)
    assert [plain.decode(x).decode() for x in want] == texts
    shared = Coder("byte_bpe_50k.tiktoken", public_tokenizers.PATTERN, Table({" cat": plain.encode_batch([" cat"])[0], "the": plain.encode_batch(["the"])[0]}))
    assert shared.encode_batch(texts) == want
