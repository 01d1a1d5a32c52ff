"""Token counts, token files and packing against the plain library and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from routecast.llm import encoding, packing, token_counts, token_files

from .conftest import TEXTS


def _ids(blob: bytes) -> list[int]:
    return np.frombuffer(blob, "<u4").tolist()


@pytest.fixture(scope="module")
def enc(tokenizer_path):
    return encoding.Encoder(encoding.read_tokenizer(tokenizer_path))


def test_words_alone_is_read_off_the_file(enc):
    import public_tokenizers

    assert enc.by_word
    assert not encoding.Encoder(encoding.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))).by_word


def test_encode_equals_library(enc, plain):
    assert [_ids(x) for x in enc.encode([t or "" for t in TEXTS])] == [plain(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("abcXYZéÉßİΣ .,'’\n\t\x1c\x85́<|endoftext|>09"), st.characters(codec="utf-8")), max_size=40), max_size=3))
def test_encode_equals_library_on_any_text(enc, plain, texts):
    assert [_ids(x) for x in enc.encode(texts)] == [plain(t) for t in texts]


def test_word_table_starts_anew(enc, plain, monkeypatch):
    monkeypatch.setattr(encoding, "KEPT_BYTES", 3)
    for texts in (["one two three four five", "six seven, eight nine. one"], ["two ten", "ten. TWO"]):
        assert [_ids(x) for x in enc.encode(texts)] == [plain(t) for t in texts]
    assert set(enc.words) <= {"two", "ten", "TWO", "ten.", "."}


def test_words_share_the_ids_of_their_stem(plain, tokenizer_path, monkeypatch):
    """Case and marks don't make new entries, and a full table keeps the words that are still in use."""
    e = encoding.Encoder(encoding.read_tokenizer(tokenizer_path))
    texts = ["Rain rain RAIN. rain,*** É é. été", "", " \t rain\x0bÉTÉ!\x1cx\x85y\xa0rain. "]
    assert [_ids(x) for x in e.encode(texts)] == [plain(t) for t in texts]
    assert {"rain", "é", "été", ".", ",***"} <= set(e.words) and not {"Rain", "RAIN.", "é.", ""} & set(e.words)
    monkeypatch.setattr(encoding, "KEPT_BYTES", 0)
    assert [_ids(x) for x in e.encode(["rain sun."])] == [plain("rain sun.")]
    assert set(e.words) == {"rain", "sun", "."}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("chunk,overlap", [(64, 8), (200, 64), (1000, 100)])
def test_spliced_equals_one_encode(name, chunk, overlap):
    import public_tokenizers
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path(name))
    rng = random.Random(chunk)
    words = ["the", "Éric's", "naïve,", "x" * 90, "42", "...", "<|endoftext|>", "é", "don't", "世界"]
    for text in (
        " ".join(rng.choice(words) for _ in range(900)),
        "\n\n".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(60)),
        "a" * 3000,  # no boundary anywhere: one encoding of the rest
        "ab " * 20 + "b" * 2000 + " cd" * 300,
        " " * 2500,
    ):
        assert _ids(encoding.encode_spliced(lib, text, chunk, overlap)) == lib.encode(text, add_special_tokens=False).ids


def test_huge_text_goes_in_chunks(enc, plain, monkeypatch):
    monkeypatch.setattr(encoding, "CHUNK", 500)
    monkeypatch.setattr(encoding, "OVERLAP", 60)
    text = " ".join(f"word{i}, and Ünïcode" for i in range(800))
    assert _ids(enc.encode([text])[0]) == plain(text)


def test_counts(odd_docs, plain, tokenizer_path):
    got = sorted(map(tuple, token_counts.count_tokens(odd_docs, tokenizer_path, limit=20).collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), n := len(plain(r.text)), n > 20) for r in odd_docs.collect()]
    assert got == sorted(want, key=str)
    assert token_counts.count_tokens(odd_docs.limit(0), tokenizer_path).count() == 0


def test_token_files_round_trip(spark, odd_docs, plain, tokenizer_path, tmp_path):
    path = str(tmp_path / "ids")
    token_files.write_token_files(odd_docs, path, tokenizer_path, end_id=2, partitions=3)
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    keys = [r.doc_id for r in rows]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens) == (at, len(r.ids))
        at += r.n_tokens
    want = sorted((str(r.doc_id), plain(r.text) + [2]) for r in odd_docs.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    crc = {(r.start, r.ids_crc32) for r in token_files.with_crc32(token_files.read_token_files(spark, path)).collect()}
    assert crc == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}


def test_token_files_empty(spark, odd_docs, tokenizer_path, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(odd_docs.limit(0), path, tokenizer_path, end_id=2)
    assert token_files.read_token_files(spark, path).count() == 0


def test_metadata_read_leaves_ids_alone(spark, odd_docs, tokenizer_path, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "meta")
    token_files.write_token_files(odd_docs, path, tokenizer_path, end_id=2, partitions=2)
    plan = token_files.read_token_files(spark, path, with_ids=False)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan.split("ReadSchema: ")[1].split("\n")[0]
    part = next((tmp_path / "meta" / "data").glob("part-*.parquet"))
    group = pq.ParquetFile(part).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "DELTA_BINARY_PACKED" in columns["n_tokens"].encodings
    assert any("DICTIONARY" in e for e in columns["ids.list.element"].encodings)
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index


def _brute_best_fit(lengths, size):
    rooms, out = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fit = [b for b, room in enumerate(rooms) if room >= lengths[i]]
        if fit:
            room = min(rooms[b] for b in fit)
            b = next(b for b in fit if rooms[b] == room)
        else:
            rooms.append(size)
            b = len(rooms) - 1
        out[i] = (b, size - rooms[b])
        rooms[b] -= lengths[i]
    return rooms


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60), st.sampled_from([50, 63, 64, 65]))
def test_best_fit_decreasing_equals_brute_force(lengths, size):
    bins, offsets = packing.best_fit_decreasing(np.array(lengths, np.int64), size)
    used: dict[int, int] = {}
    for b, o, n in sorted(zip(bins.tolist(), offsets.tolist(), lengths), key=lambda x: (x[0], x[1], x[2])):
        assert o == used.get(b, 0)
        used[b] = o + n
    assert all(n <= size for n in used.values())
    # Equal rooms may be swapped, so the bins' fill levels are what has to agree.
    assert sorted(used.values()) == sorted(size - r for r in _brute_best_fit(lengths, size))


def test_empty_lengths_open_no_bin_beside_full_ones():
    bins, offsets = packing.best_fit_decreasing(np.array([0, 50, 0], np.int64), 50)
    assert bins.tolist() == [0, 0, 0] and offsets.tolist() == [50, 0, 50]
    assert packing.best_fit_decreasing(np.array([0, 0], np.int64), 50)[0].tolist() == [0, 0]


def test_pack_documents(odd_docs, plain, tokenizer_path):
    size = 64
    rows = packing.pack_documents(odd_docs, tokenizer_path, 1, size, group_rows=8).collect()
    want = []
    for r in odd_docs.collect():
        ids = plain(r.text) + [1]
        want += [(r.doc_id, a // size, a, len(ids[a : a + size]), zlib.crc32(np.array(ids[a : a + size], "<u4").tobytes())) for a in range(0, len(ids), size)]
    assert sorted(map(str, ((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows))) == sorted(map(str, want))
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size


def test_pack_with_ids_and_clashing_columns(spark, odd_docs, tokenizer_path, plain):
    pieces = packing.token_pieces(odd_docs, tokenizer_path, 1, 64, with_ids=True)
    assert sorted(i for r in pieces.collect() for i in r.ids) == sorted(i for r in odd_docs.collect() for i in plain(r.text) + [1])
    items = spark.createDataFrame([("a", None, 5), ("a", 3, 5), (None, 9, 6)], "offset string, length long, _group long")
    out = packing.pack(items, size=10)
    assert out.columns == ["length", "sequence_id", "offset"] and out.count() == 3
    assert packing.pack(items.limit(0), size=10).count() == 0


def test_pack_rejects_what_cannot_fit(spark):
    with pytest.raises(Exception, match="outside"):
        packing.pack(spark.createDataFrame([(11,)], "length long"), size=10).collect()


def test_words_with_all_kinds_of_ends(plain, tokenizer_path):
    """Marks in runs after letters of any case, contractions, special tokens and marks alone, each word alone and all in a row."""
    stems = ["Word", "ÉTÉ", "naïve", "x", "ß", "can't", "a<|endoftext|>", "<|startoftext|>", "3rd", "don", ""]
    ends = ["", ".", ",", "!!", "?!.", "$$$", "&&&", "***", "%%%", "###", ",***", ";:", "'s", "!'s", "|", "</w>"]
    words = [s + e for s in stems for e in ends]
    e = encoding.Encoder(encoding.read_tokenizer(tokenizer_path))
    assert e.by_word
    for texts in (words, [" ".join(words)], [w * 2 for w in words], [w.upper() for w in words]):
        assert [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts)] == [plain(t) for t in texts]


def test_texts_without_white_space_are_not_kept(tokenizer_path, monkeypatch):
    """5,000 words of 20,000 characters: none stays, and the table starts anew beyond its bytes."""
    import resource

    e = encoding.Encoder(encoding.read_tokenizer(tokenizer_path))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for lo in range(0, 5000, 50):
        e.encode([f"{i:05d}" + "ab" * 10_000 for i in range(lo, lo + 50)])
    assert not any(len(w) > encoding.LONGEST_KEPT for w in e.words) and 0 <= e.kept_bytes < 1 << 20
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024 < 300
    monkeypatch.setattr(encoding, "KEPT_BYTES", 10_000)
    for i in range(20):
        e.encode([" ".join(f"w{chr(97 + i)}{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300))])
    assert len(e.words) < 1000
