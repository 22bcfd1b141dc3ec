import base64
import random
import sys
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from creelgrid.llm import byte_bpe, token_files, units, word_pieces

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
HARD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a \n b\n\n c", "tab\tx y", "don't we'll I'M", "x" * 700, "ab" * 400 + " " + "é" * 300,
    "nbsp\xa0x \xa0 y", "em space", "123 4567", "<|endoftext|> a", "🙂🙂 naïve ÀÉ", "\x1c \x1d", "...!!! ???", "\r\n \r\n", "a　b 　c",
]


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    alphabet = ["a", "b", "the", " ", " ", "\n", "'s", "é", "9", "!", "ing", "\t", "  ", "Z", "\xa0", "🙂"]
    return HARD + ["".join(random.choices(alphabet, k=random.randint(0, 60))) for _ in range(400)]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken

    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_as_the_library(texts, tiktoken_encoding):
    coder = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    for text, ids in zip(texts, coder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tiktoken_encoding.encode_ordinary(text), text[:80]
        assert coder.decode(ids) == text.encode()


def test_matrix_and_heap_agree():
    ranks = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN).ranks
    random.seed(1)
    pieces = [bytes(random.choices(b"abcdeinst\xc3\xa9", k=random.randint(1, 60))) for _ in range(300)]
    for piece, ids in zip(pieces, ranks.pieces(pieces)):
        assert ids.tolist() == ranks.merge_heap(piece).tolist()


def test_new_words_cost_no_calls_each(tiktoken_encoding):
    random.seed(6)
    coder = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    words = list({" " + "".join(random.choices(["en", "th", "tion", "é", "ou", "st"], k=6)) for _ in range(5000)})
    calls = []
    sys.setprofile(lambda frame, event, arg: calls.append(None) if event in ("call", "c_call") else None)
    try:
        got = coder.encode_units(words)
    finally:
        sys.setprofile(None)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tiktoken_encoding.encode_ordinary(w) for w in words]
    assert len(calls) < len(words)


def test_pieces_of_all_lengths_and_none():
    ranks = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN).ranks
    random.seed(7)
    lengths = [*range(0, 300), 900, 1, 256, 257, 9, 9]
    random.shuffle(lengths)
    pieces = [bytes(random.choices(b"abtheinst \xc3\xa9", k=n)) for n in lengths]
    assert [x.tolist() for x in ranks.pieces(pieces)] == [ranks.merge_heap(p).tolist() if p else [] for p in pieces]
    assert ranks.pieces([]) == [] and [x.tolist() for x in ranks.pieces([b""])] == [[]]


def test_cache_that_is_full(texts):
    coder = byte_bpe.encoder(RANKS, public_tokenizers.PATTERN)
    small = units.UnitCache(coder.encode_units, most=5, longest=4)
    for _ in range(2):
        for text in texts:
            assert small.texts([text, text]) == coder.encode([text, text])


def test_words_are_encoded_once_whatever_marks_follow_them(tiktoken_encoding):
    seen: list[list[str]] = []

    def encode(new):
        seen.append(new)
        return byte_bpe.encoder(RANKS, public_tokenizers.PATTERN).encode_units(new)

    marks = ["", ",", ".", ".\nUnd", "'s", "...", "½", "\u0301,", "9", "_x", "\x00", "|", "É!"]
    words = [f"{w}{m}" for w in ("und", "École", "ɏa") for m in marks]
    texts = [" ".join(words), "x", "", None, "  ".join(words), " ".join(reversed(words)) + " "]
    cache = units.UnitCache(encode)
    got = [np.frombuffer(x, "<u4").tolist() for x in cache.texts(texts)]
    assert got == [tiktoken_encoding.encode(t or "") for t in texts]
    asked = [x for new in seen for x in new]
    assert " und" in asked and not {" und,", " und.\nUnd", " École..."} & set(asked)
    assert len(asked) == len(set(asked))


def test_many_new_words_are_encoded_some_at_a_time(monkeypatch):
    sizes = []
    monkeypatch.setattr(units, "_AT_ONCE", 100)
    cache = units.UnitCache(lambda new: sizes.append(len(new)) or [x.encode() for x in new])
    text = " ".join(f"w{i}" for i in range(1000))
    assert cache.texts([text]) == [text.encode()] and max(sizes) <= 100


def test_arrow_batches_are_bounded_by_bytes(spark):
    from creelgrid.session import configure

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.nbytes], pa.int64())})

    texts = configure(spark).range(0, 40, 1, 1).selectExpr("repeat('x', 1000000) as text")
    found = [r.n for r in texts.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 40_000_000 and max(found) < 8_000_000


def test_bpe_query_columns(odd_docs):
    rows = byte_bpe.encode_decode(odd_docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.decoded.decode() for r in rows)) == sorted(r.text or "" for r in odd_docs.collect())
    assert all(r.n_tokens * 4 == len(r.ids) for r in rows)
    assert byte_bpe.encode_decode(odd_docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_files_round_trip(spark, odd_docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate([*texts, "a <|endoftext|> b", "x<|endoftext|>", "<|endoftext|>y z<|endoftext|>\n"])], "doc_id long, text string"))
    got = sorted((tuple(r) for r in token_files.token_files(docs, JSON).collect()), key=lambda r: r[1])
    want, start = [], 0
    ordered = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, (r.text or "").encode()))
    for r in ordered:
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert token_files.token_files(docs.limit(0), JSON).collect() == []


def test_sequences_by_place(tmp_path):
    schema = token_files.file_schema(8, 50257)
    docs = [np.arange(k, k + n, dtype=np.uint32) for k, n in ((0, 5), (5, 20), (25, 0), (25, 40), (65, 1))]
    path = str(tmp_path / "a.arrow")
    with pa.OSFile(path, "wb") as sink:
        writer = token_files.SequenceWriter(sink, schema, rows=2)
        for d in docs:
            writer.add(d)
        writer.close()
    file = token_files.SequenceFile(path)
    assert len(file) == 9 and writer.total == 66
    flat = np.concatenate([file[i][0] for i in range(9)])
    real = np.concatenate([file[i][1].to_numpy(zero_copy_only=False) for i in range(9)])
    assert flat[real].tolist() == list(range(66)) and real.sum() == 66 and not flat[~real].any()
    assert file[3][0].base is not None  # a view, not a copy
    with pytest.raises(IndexError):
        file[9]


def naive(word, initial, later):
    at, n = 0, 0
    while at < len(word):
        pieces = initial if at == 0 else later
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in pieces), 0)
        if not size:
            return -1
        at, n = at + size, n + 1
    return n


def test_word_pieces_against_longest_match():
    random.seed(3)
    for _ in range(60):
        make = lambda k: {bytes(random.choices(b"abc", k=random.randint(1, 5))) for _ in range(k)}
        initial, later = make(8), make(10)
        automaton = word_pieces.Automaton(sorted(initial), sorted(later))
        for _ in range(60):
            word = bytes(random.choices(b"abc", k=random.randint(0, 14)))
            assert automaton.count(word) == naive(word, initial, later), (word, initial, later)


def test_word_pieces_as_the_library():
    from tokenizers import Tokenizer, models

    random.seed(4)
    initial = ["a", "b", "c", "ab", "abc", "bca"]
    later = ["a", "b", "ca", "cab", "bb", "c"]
    vocabulary = {t: i for i, t in enumerate(["[UNK]", *initial, *("##" + x for x in later)])}
    library = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=1000))
    automaton = word_pieces.Automaton([x.encode() for x in initial], [x.encode() for x in later])
    for _ in range(300):
        word = "".join(random.choices("abcd", [5, 5, 5, 1], k=random.randint(1, 20)))
        found = library.encode(word, add_special_tokens=False).tokens
        assert (-1 if found == ["[UNK]"] else len(found)) == automaton.count(word.encode())


def test_word_piece_counts(odd_docs):
    automaton = word_pieces.rank_file_automaton(RANKS)
    rows = word_pieces.count_pieces(odd_docs, RANKS).collect()
    want = []
    for r in odd_docs.collect():
        words = (r.text or "").encode().split()
        want.append((r.doc_id, len(words), sum(map(automaton.count, words)), 0))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert odd_docs.filter(F.lit(False)).transform(lambda d: word_pieces.count_pieces(d, RANKS)).count() == 0
