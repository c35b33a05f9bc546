import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from chunksink.llm import bpe, simple8b

BYTE, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts(n=4000):
    r = random.Random(3)
    letters = [*"abc  \n\t'sDÉ́ \x1c\x85　漢1٣²!?<|>🙂İΣς…“", "<|endoftext|>", "<|startoftext|>", " \n", "'ll", "The "]
    out = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(n)]
    out += ["".join(chr(r.choice([r.randint(0, 0x2FF), r.randint(0x2000, 0x20FF), r.randint(0x300, 0xD7FF), 32])) for _ in range(20)) for _ in range(n)]
    return out + ["".join(r.choice("ab ") for _ in range(50)) for _ in range(200)] + ["", None, "a" * 5000, "word " * 30_000]


def ids_of(tokenizer, texts):
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def listed(coded):
    return [np.frombuffer(x, "<u4").tolist() for x in coded]


def test_byte_bpe_matches_the_library():
    texts, own, library = odd_texts(), bpe.ByteBPE(BYTE), Tokenizer.from_file(BYTE)
    coded = own.encode_batch(texts)
    want = ids_of(library, texts)
    assert listed(coded) == want
    assert [own.decode(x) for x in coded] == [library.decode(x, skip_special_tokens=False) for x in want]


def test_ranks_that_a_merge_can_undercut(tmp_path):
    """A pair of lower rank may appear only after a later merge."""
    import json

    symbols = bpe.byte_symbols()
    merges = [("a", "b"), ("ab", "c"), ("abc", "a"), ("b", "c"), ("a", "bc"), ("a", "a"), ("aa", "aa")]
    vocab = {c: i for i, c in enumerate(symbols)}
    for x, y in merges:
        vocab.setdefault(x + y, len(vocab))
    spec = json.load(open(BYTE))
    spec["model"] |= {"vocab": vocab, "merges": [list(m) for m in reversed(merges)]}
    spec["added_tokens"] = []
    (path := tmp_path / "t.json").write_text(json.dumps(spec))
    r = random.Random(1)
    texts = ["".join(r.choice("abc ") for _ in range(30)) for _ in range(3000)]
    assert listed(bpe.ByteBPE(str(path)).encode_batch(texts)) == ids_of(Tokenizer.from_file(str(path)), texts)


def test_word_ids_match_the_library():
    texts, own = odd_texts(), simple8b._Words(WORD)
    want = ids_of(Tokenizer.from_file(WORD), texts)
    for _ in range(2):  # with and without its memo
        ids, size = own.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == want
    ids, size = own.encode([])
    assert len(ids) == len(size) == 0


def test_repeated_words_are_looked_up_once():
    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

        def __getitem__(self, k):
            Counted.asked += 1
            return super().__getitem__(k)

    own, texts = simple8b._Words(WORD), ["the end of the word " * 2000, " \tthe  end\n", "", None, "the漢 end \ud7ff", "of"]
    own.encode(texts)
    own.words.of, own.parts.of = Counted(own.words.of), Counted(own.parts.of)
    ids, size = own.encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == ids_of(Tokenizer.from_file(WORD), texts)
    assert Counted.asked <= 20


@pytest.mark.parametrize("n", [0, 1, 5, 1023, 1024, 1025, 20_000])
@pytest.mark.parametrize("most", [2, 300, 50_000, 2**32, 2**64 - 1])
def test_simple8b_round_trip(n, most):
    r = np.random.default_rng(n)
    v = r.integers(0, most, n, dtype=np.uint64)
    v[r.random(n) < 0.3] = 0
    words, offsets = simple8b.pack(v)
    assert (simple8b.unpack(words, offsets, n) == v).all()
    assert len(offsets) == -(-n // simple8b.BLOCK)


def test_files_round_trip(spark, tmp_path):
    rows = [(5, "The end."), (None, "no id"), (3, None), (4, ""), (9, "a b c " * 9000), (3, "again")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, ids string")
    simple8b.write_ids(df, f"file://{tmp_path}/ids", WORD, 1)
    got = [(r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in simple8b.read_ids(spark, f"file://{tmp_path}/ids").collect()]
    library = Tokenizer.from_file(WORD)
    want = sorted(((d, library.encode(t or "", add_special_tokens=False).ids + [1]) for d, t in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    got.sort(key=lambda x: x[1])
    assert [g[0] for g in got] == [w[0] for w in want]
    assert sorted((str(g[0]), g[2]) for g in got) == sorted((str(w[0]), w[1]) for w in want)
    at = 0
    for _, start, ids in got:
        assert start == at
        at += len(ids)
    simple8b.write_ids(df.limit(0), f"file://{tmp_path}/none", WORD, 1)
    assert simple8b.read_ids(spark, f"file://{tmp_path}/none").count() == 0


def test_bpe_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "The end. <|endoftext|>", "x"), (3, "The end. <|endoftext|>", "x")], "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(df, BYTE), BYTE).orderBy("doc_id").collect()
    assert [r.decoded for r in got] == ["", "", "The end. <|endoftext|>", "The end. <|endoftext|>"]
    assert bpe.encode(df.limit(0), BYTE).count() == 0


def test_one_pass_equals_two(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(odd_texts(200))], "doc_id long, text string, decoded string")
    once = bpe.encode(df, BYTE, decoded="decoded")
    twice = bpe.decode(bpe.encode(df, BYTE), BYTE)
    rows = lambda d: sorted(map(tuple, d.select("doc_id", "ids", "decoded").collect()))
    assert once.columns == ["doc_id", "text", "ids", "decoded"]
    assert rows(once) == rows(twice)
    assert bpe.encode(df.limit(0), BYTE, decoded="decoded").count() == 0
