"""Operators 1, 3 and 7."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from statutelake.llm import sentencepieces, token_counts, token_files
from statutelake.llm.session import prepare, shared_path, table
from statutelake.llm.vocabularies import vocabulary
from statutelake.llm.wordcache import WordCache, pieces

PIECES, WORDS = vocabulary("piece_bpe_32k.model"), vocabulary("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "a", "  a  b   ", "The cat's 12 hats, isn't it?\n\tYes!", "ÉTÉ à la plage… ça va?", "日本語のテキスト 東京", "áë ΣΑΣ İI",
    "<|endoftext|> x<|startoftext|>y", "word " * 400, "x" * 300, "\x1c\x00odd line", "🙂👩‍👩‍👧 é", "end ",
]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "a"), (3, "a"), (None, "no id here"), (70, "word " * 400)]


def test_pieces_of_text_are_cut_at_spaces():
    text = "ab cd  ef ghijkl m"
    assert " ".join(pieces(text, 3)) == text
    assert list(pieces("x" * 50, 3)) == ["x" * 50]


def test_word_cache_empties_itself_and_stays_right():
    memo = WordCache(lambda ws: [[len(w), ord(w[0])] for w in ws], limit=3)
    for words in (["a", "bb"], ["ccc", "a", "d"], ["e", "f", "a"], ["bb"] * 5):
        assert memo.gather(words).tolist() == [x for w in words for x in (len(w), ord(w[0]))]


def test_ids_equal_the_library_and_files_round_trip(spark, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    prepare(spark)
    path = shared_path(spark, "test-ids")
    token_files.write_ids(documents(ROWS), path, WORDS, files=3)
    got = sorted(((r["doc_id"], r["ids"]) for r in token_files.read_ids(spark, path).collect()), key=str)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in ROWS), key=str)
    assert got == want
    at, rows = 0, {}
    for r in sorted(token_files.digest(spark, path).collect(), key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
        rows.setdefault(r["doc_id"], []).append(r["ids_crc32"])
    order = sorted(rows, key=lambda i: (i is not None, i or 0))
    assert list(rows) == order and at == sum(len(ids) for _, ids in want)
    for i, ids in want:
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) in rows[i]
    assert [r["ids"] for r in token_files.find_ids(spark, path, [5]).collect()] == [ids for i, ids in want if i == 5]


def test_files_prune_by_document(spark, documents):
    prepare(spark)
    path = shared_path(spark, "test-prune")
    token_files.write_ids(documents([(i, f"text {i}") for i in range(50)]), path, WORDS, files=4)
    plan = token_files.find_ids(spark, path, [7])._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,7)" in plan or "In(doc_id, [7])" in plan


def test_no_documents(spark, documents):
    prepare(spark)
    path = shared_path(spark, "test-none")
    token_files.write_ids(documents([]), path, WORDS, files=2)
    assert token_files.digest(spark, path).count() == 0
    assert token_counts.count_tokens(documents([]), PIECES).count() == 0
    assert sentencepieces.encode(documents([]), PIECES).count() == 0


def greedy(word, initial, inner):
    """Longest match from the left, by trying every length."""
    at, n, known = 0, 0, initial
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in known), 0)
        if not size:
            return 1
        at, n, known = at + size, n + 1, inner
    return n


def test_counts_equal_greedy_matching():
    initial, inner = {"a", "ab", "abc", "b", "abcde", "cc"}, {"a", "b", "bc", "d", "ce", "cede", "e"}
    automaton = token_counts.Automaton(initial, inner)
    rng = random.Random(3)
    words = ["", "z", "abz"] + ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    assert [automaton.count(w) for w in words] == [greedy(w, initial, inner) for w in words]


def test_counts_of_whole_texts(spark, documents):
    prepare(spark)
    initial, inner = token_counts.piece_vocabulary(PIECES)
    got = sorted((tuple(r) for r in token_counts.count_tokens(documents(ROWS), PIECES).collect()), key=str)
    want = []
    for i, t in ROWS:
        words = token_counts.split_words(t or "")
        want.append((i, len(words), sum(greedy(w, initial, inner) for w in words)))
    assert got == sorted(want, key=str)


def test_counts_equal_the_library_on_words(spark, sf):
    from tokenizers import Tokenizer, models

    initial, inner = token_counts.piece_vocabulary(PIECES)
    vocab = {w: i for i, w in enumerate(["[UNK]", *sorted(initial), *("##" + w for w in sorted(inner))])}
    library = Tokenizer(models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10**6))
    text = " ".join(r["text"] for r in table(spark, sf, "documents").limit(60).collect())
    words = list(dict.fromkeys(token_counts.split_words(text)))
    automaton = token_counts.Automaton(initial, inner)
    assert [automaton.count(w) for w in words] == [len(library.encode(w).ids) for w in words]


@pytest.fixture(scope="module")
def model():
    return sentencepieces.model_of(PIECES)


def best_sum(model, text):
    """Best sum by trying every piece at every place."""
    text = "▁" + text.replace(" ", "▁")
    table = {model.text[i]: v for i, v in enumerate(_scores(model)) if v is not None}
    best = [0] + [None] * len(text)
    for end in range(1, len(text) + 1):
        options = [best[s] + table[text[s:end]] for s in range(max(0, end - model.longest), end) if text[s:end] in table]
        if text[end - 1 : end] not in table:
            options.append(best[end - 1] + model.penalty)
        best[end] = max(options)
    return best[-1]


def _scores(model):
    out = [None] * len(model.text)

    def walk(node):
        for key, child in node.items():
            if key == "":
                out[child[1]] = child[0]
            else:
                walk(child)

    walk(model.trie)
    return out


def test_segmentation_is_the_best_one_and_never_below_the_library(model):
    import sentencepiece

    base = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    # The same model with its type set to unigram (field 3 of the trainer settings).
    unigram = sentencepiece.SentencePieceProcessor(model_proto=base.serialized_model_proto() + bytes([0x12, 2, 0x18, 1]))
    rng = random.Random(5)
    texts = ["".join(rng.choice("aehnot rs,") for _ in range(rng.randint(1, 60))).strip() or "a" for _ in range(200)]
    scores = _scores(model)
    for text in texts:
        ids = model.words.gather(sentencepieces.words_of(text)).tolist()
        mine = sum(scores[i] for i in ids)
        assert mine == best_sum(model, text)
        if "  " not in text:
            assert mine >= sum(scores[i] for i in unigram.encode(text))


def encoded(spark, df, **options):
    rows = {}
    for r in sentencepieces.encode(df, PIECES, **options).collect():
        rows.setdefault(r["doc_id"], {}).setdefault(r["part"], []).append(r["ids"])
    return rows


def test_chunks_do_not_change_the_pieces_and_texts_come_back(spark, documents, model):
    prepare(spark)
    rng = random.Random(11)
    texts = [t for t in TEXTS if t] + ["".join(rng.choice("ab the") for _ in range(90)), "aaaaaaaaab" * 9, "...." * 20 + " " + "international" * 6]
    rows = list(enumerate(texts))
    df = documents(rows)
    whole = encoded(spark, df)
    for chunk in (1, 7, 40):
        parts = encoded(spark, df, chunk=chunk)
        for i, text in rows:
            flat = [x for p in sorted(parts[i]) for x in parts[i][p][0]]
            assert flat == whole[i][0][0], (chunk, text)
        assert max(len(p) for p in parts.values()) > 1
        back = {}
        for r in sentencepieces.decode(sentencepieces.encode(df, PIECES, chunk=chunk), PIECES).collect():
            back.setdefault(r["doc_id"], {})[r["part"]] = r["text"]
        assert {i: "".join(back[i][p] for p in sorted(back[i])) for i, _ in rows} == dict(rows)


def test_many_blocks_of_chunks(spark, documents, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(sentencepieces, "BLOCK", 4)
    text = "the theatre of the " * 5 + "x" * 60 + " extraordinary" * 4
    parts = encoded(spark, documents([(1, text)]), chunk=5)
    assert [x for p in sorted(parts[1]) for x in parts[1][p][0]] == encoded(spark, documents([(1, text)]))[1][0][0]


def test_nulls_and_repeated_rows_are_encoded_each(spark, documents):
    prepare(spark)
    rows = encoded(spark, documents([(1, None), (2, ""), (None, "no id"), (3, "same text here"), (3, "same text here")]), chunk=4)
    assert rows[1] == {0: [[]]} and rows[2] == {0: [[]]}
    assert len(rows[3][0]) == 2 and None in rows
    digest = sentencepieces.digest(sentencepieces.encode(documents([(1, "a  b\n")]), PIECES), PIECES).first()
    assert (digest["text_bytes"], digest["text_crc32"]) == (5, zlib.crc32(b"a  b\n"))


ODD = ["", "a", " lead", "  two", "trail  ", "x\0y\n", "漢字😀é", "\ud800", "<0x41>", "international" * 9, "aaaaaaaaab" * 5, "...." * 20, "é" * 64, "é" * 63]


def test_words_of_a_slice_are_worked_out_together(model, monkeypatch):
    one = []
    for word in ODD:
        text = "▁" + word.replace(" ", "▁")
        _, back, last = model.forward(text, {0: 0}, len(text))
        one.append(model.trace(text, back, last, len(text))[0])
    sizes, flat = model._words(ODD)
    assert [r.tolist() for r in np.split(flat, np.cumsum(sizes)[:-1])] == one
    # Short words need no search of their own, and a slice of texts asks the memo's work once.
    model.words.clear()
    calls = []
    monkeypatch.setattr(model, "forward", None)
    monkeypatch.setattr(model.words, "work", lambda words: calls.append(len(words)) or model._words(words))
    batch = pa.record_batch([pa.array(["1", "2", "3", "4"]), pa.array(["one two", None, "", "two  three"])], ["row", "text"])
    ids = [r.as_py() for b in sentencepieces._encode_short(PIECES)([batch]) for r in b.column(2)]
    model.words.clear()
    assert calls == [3] and ids[1:3] == [[], []] and model.decode(ids[0]) == b" one two" and model.decode(ids[3]) == b" two  three"


def test_slices_of_a_batch_keep_rows_and_order(monkeypatch):
    monkeypatch.setattr(sentencepieces, "SLICE", 10)
    texts = ["one", None, "two words here", "", "x", "y" * 30, "z"]
    batch = pa.record_batch([pa.array([str(i) for i in range(7)]), pa.array(texts)], ["row", "text"])
    out = list(sentencepieces._encode_short(PIECES)([batch, batch.slice(0, 0)]))
    assert [r for b in out for r in b.column(0).to_pylist()] == [str(i) for i in range(7)]
    monkeypatch.setattr(sentencepieces, "SLICE", 1 << 20)
    assert [r for b in out for r in b.column(2).to_pylist()] == [r for b in sentencepieces._encode_short(PIECES)([batch]) for r in b.column(2).to_pylist()]


def test_chunks_are_held_one_at_a_time_and_fill_no_memo(model, monkeypatch):
    import weakref

    alive, most = weakref.WeakSet(), []

    class Watched(sentencepieces.Chunk):
        def __init__(self, *args):
            super().__init__(*args)
            alive.add(self)
            most.append(len(alive))

    monkeypatch.setattr(sentencepieces, "Chunk", Watched)
    model.words.clear()
    rows = [("r", i, "x" + "some words of a chunk " * 4) for i in range(20)]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], ["row", "part", "text"])
    out = list(sentencepieces._on_chunks(PIECES, 60, "matrix")([batch]))
    assert sum(b.num_rows for b in out) == 20 and max(most) <= 2
    # The words between the first and the last cut are worked out once, for the ids.
    assert not model.words.index and not hasattr(model, "scores") and model.words.limit <= 200_000
