"""SentencePiece, token counts and chat format against the tokenizer libraries."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from conftest import SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfwise.llm import chat, pieces, queries, tokencount
from shelfwise.llm.common import table

FRAGMENTS = ["a", "b", "E", "é", "É", " ", "  ", "\n", "\t", "\x0b", "\x85", "\x1c", ".", ",", "'s", "'LL", "1", "2", "the ", "ing", "漢", "字",
             "🙂", "ﬁ", "İ", "Σ", "ς", "́", "▁", "\x00", "<", ">", "</s>", "<s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "s>", "[",
             "INST]", "<|role|>", "<|endoftext|>", "<|startoftext|>", "<0x0A>", "a" * 60, "=" * 50]
TEXTS = st.lists(st.one_of(st.sampled_from(FRAGMENTS), st.characters(exclude_categories=["Cs", "Cn"])), max_size=20).map("".join)


@pytest.fixture(scope="module")
def piece_model():
    with open(queries.PIECES, "rb") as f:
        return pieces.PieceModel(f.read()), sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


@pytest.fixture(scope="module")
def word_counter():
    with open(queries.WORD_BPE, encoding="utf-8") as f:
        vocab = tokencount.Vocabulary(f.read())
    return tokencount.Counter(vocab, vocab.whole_words()), tokenizers.Tokenizer.from_file(queries.WORD_BPE)


@pytest.fixture(scope="module")
def codec():
    with open(queries.BYTE_BPE, encoding="utf-8") as f:
        return chat.Codec(f.read())


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_pieces_equal_the_library(piece_model, texts):
    model, sp = piece_model
    got = [x.tolist() for x in model.encode(texts)]
    assert got == [sp.encode(t) for t in texts]
    assert [model.decode(np.array(x, np.int32)) for x in got] == [t.replace("▁", " ") for t in texts]


def test_pieces_of_the_table(spark, piece_model):
    docs = table(spark, SF_SMALL, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    encoded = pieces.encode(docs, queries.PIECES)
    assert {r["doc_id"]: r["ids"] for r in encoded.collect()} == {i: piece_model[1].encode(t) for i, t in texts.items()}
    assert {r["doc_id"]: r["text"] for r in pieces.decode(encoded, queries.PIECES).collect()} == texts
    for r in queries.op4_sentencepiece(spark, SF_SMALL).collect():
        ids = piece_model[1].encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert r["round_trip"] and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_piece_edges(spark, piece_model, monkeypatch):
    long = "abcé " * 30_000 + "x" * 5000 + "漢字" * 3000
    rows = [(1, None), (2, ""), (3, " "), (3, " "), (None, "a\nb"), (4, long)]
    df = spark.createDataFrame([(*r, [1]) for r in rows], "doc_id long, text string, ids array<int>")
    got = collections.Counter((r["doc_id"], tuple(r["ids"])) for r in pieces.encode(df, queries.PIECES).collect())
    assert got == collections.Counter((i, tuple(piece_model[1].encode(t or ""))) for i, t in rows)
    assert {r["round_trip"] for r in pieces.encode_checked(df, queries.PIECES).collect()} == {True}
    assert pieces.encode_digest(df.limit(0), queries.PIECES).count() == 0
    monkeypatch.setattr(pieces, "INDEX_CHARS", 50)  # many small suffix arrays give the same ids
    monkeypatch.setattr(pieces, "KEEP", 3)
    for t in ("the quick brown fox " * 20, "été à Paris\n\n fin", long[-400:]):
        assert piece_model[0].encode([t, t])[1].tolist() == piece_model[1].encode(t)


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_token_counts_equal_the_library(word_counter, text):
    assert word_counter[0].count(text) == len(word_counter[1].encode(text, add_special_tokens=False).ids)


def test_whole_words_are_single_tokens(word_counter):
    counter, tok = word_counter
    one = [len(e.ids) for e in tok.encode_batch(counter.whole, add_special_tokens=False)]
    # a string of several pre-tokens (as "it's") is never looked up whole
    single = [w for w in counter.whole if counter.find(tokencount.normalized(w)) == [w]]
    assert len(single) > 30_000
    assert all(n == 1 for w, n in zip(counter.whole, one) if w in set(single))


def test_long_pre_tokens_merge_alike(word_counter, monkeypatch):
    words = ["=" * 300, "abcabc" * 50, "été" * 40, "internationalisation"]
    want = [len(word_counter[1].encode(w, add_special_tokens=False).ids) for w in words]
    assert [word_counter[0].vocab.merge_count(w) for w in words] == want
    monkeypatch.setattr(tokencount, "SHORT", 1)
    assert [word_counter[0].vocab.merge_count(w) for w in words] == want
    monkeypatch.setattr(tokencount, "SHORT", 1000)
    assert [word_counter[0].vocab.merge_count(w) for w in words] == want


def test_stores_are_bounded_by_characters(piece_model, word_counter, monkeypatch):
    monkeypatch.setattr(pieces, "KEEP_CHARS", 20_000)
    monkeypatch.setattr(tokencount, "KEEP_CHARS", 20_000)
    letters = "abcdefghijklmnopqrstuvwxyzé"
    for i in range(30):  # texts without a space: each is one segment
        text = "".join(letters[(i * 7 + j * j * (i + 1)) % len(letters)] for j in range(3000))
        assert piece_model[0].encode([text])[0].tolist() == piece_model[1].encode(text)
        assert sum(map(len, piece_model[0].known)) <= 20_000
        assert word_counter[0].count(text) == len(word_counter[1].encode(text, add_special_tokens=False).ids)
        assert sum(len(w) for w in list(word_counter[0].words)[len(word_counter[0].whole):]) <= 20_000


def test_token_counts_of_the_table_and_edges(spark, word_counter):
    tok = word_counter[1]
    count = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    docs = table(spark, SF_SMALL, "documents")
    want = {r["doc_id"]: (len(r["text"].encode()), count(r["text"]), count(r["text"]) > 2048) for r in docs.collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in queries.op9_token_counts(spark, SF_SMALL).collect()} == want
    rows = [(1, None), (2, ""), (3, "ab <|endoftext|>x"), (3, "ab <|endoftext|>x"), (None, "é" * 9000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_tokens int")
    got = tokencount.count_tokens(df, queries.WORD_BPE)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(
        (i, len((t or "").encode()), count(t), count(t) > 2048) for i, t in rows)
    assert tokencount.count_tokens(df.limit(0), queries.WORD_BPE).count() == 0


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_escape_hides_control_strings_and_is_reversible(codec, text):
    hidden = chat.escape(text)
    assert not any(c in hidden for c in chat.CONTROLS)
    assert chat.unescape(hidden) == text
    assert codec.decode(codec.encode([hidden])[0]) == hidden


def plain_chat(rows):
    by = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        chars = len("<s>")
        for _, r, t in turns:
            head = len(chat.CONTROLS[chat.ROLES[r]]) if r in chat.ROLES else len(chat.escape(r)) + len("<|role|><|body|>")
            chars += head + len(chat.escape(t)) + len("</s>")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                     len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), chars)
    return out


def test_chat_of_the_table_reads_back(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op8_chat_format(spark, SF_SMALL).collect()}
    assert got == plain_chat(rows)


def test_chat_tokens_and_mask(spark, codec):
    df = spark.createDataFrame([(1, 0, "user", "hi </s>"), (1, 1, "assistant", "yes"), (1, 2, "tool", "42")],
                               "conv_id long, turn long, role string, text string")
    out = chat.format_turns(df, queries.BYTE_BPE).orderBy("turn").collect()
    base = codec.first
    assert out[0]["ids"][:2] == [base + chat.BEGIN, base + chat.USER] and out[0]["ids"][-1] == base + chat.END
    assert sum(x >= base for x in out[0]["ids"]) == 3 and not any(out[0]["loss"])
    assert out[1]["ids"] == [base + chat.ASSISTANT, *codec.encode(["yes"])[0], base + chat.END]
    assert out[1]["loss"] == [False] + [True] * (len(out[1]["ids"]) - 2) + [False]
    assert out[2]["ids"][0] == base + chat.ROLE and not any(out[2]["loss"])


def test_chat_edges(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "x"), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (2, None, "user", ""),
            (None, 3, "we<s>ird", "[\\INST] a"), (None, 4, "assistant", "é🙂" * 3000), (3, 5, "assistant", "<"), (3, 6, "assistant", "s>")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(chat.format_turns(df, queries.BYTE_BPE), queries.BYTE_BPE).collect()}
    assert got == plain_chat(rows)
    assert chat.read_back(chat.format_turns(df.limit(0), queries.BYTE_BPE), queries.BYTE_BPE).count() == 0


def test_chat_with_many_equal_and_null_turns(spark):
    rows = [(None if i % 2 else 5, None, "assistant" if i % 3 else "user", f"line {i % 50}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    out = chat.format_turns(df, queries.BYTE_BPE)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan  # no turn is gathered into one row
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(out, queries.BYTE_BPE).collect()}
    assert got == plain_chat(rows)


def test_tokenizer_paths_are_the_public_files():
    assert queries.PIECES == public_tokenizers.path("piece_bpe_32k.model")
