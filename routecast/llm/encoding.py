"""Exact token ids of whole texts, in bounded memory.

Two ways, with equal results (tests compare both with the library):

* Texts of usual size are cut at white space, and each distinct word of some
  hundred texts is looked up in a per-process table of encoded words. This is exact only for a tokenizer that
  drops white space and encodes each word alone; :func:`_encodes_words_alone`
  reads that off the tokenizer's own file, and any other tokenizer gets the
  library's plain ``encode``.
* A huge text is encoded in overlapping chunks that are spliced where both
  chunks agree (:func:`encode_spliced`).

Ids are ``bytes`` of little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A text longer than this many code points is encoded in chunks of this size.
CHUNK = 1 << 16
#: First overlap of two chunks, in code points; doubled while they don't agree.
OVERLAP = 1 << 10
#: Bytes of words and ids that a process keeps, with so many for an entry besides; beyond, only words in use stay in the table.
KEPT_BYTES, ENTRY_BYTES = 96 << 20, 160
#: A word of more code points is never kept: texts without white space are such words.
LONGEST_KEPT = 64
#: Stems that are encoded in one piece.
TOGETHER = 2000
#: Tokens that must agree on both sides of a splice.
AGREE = 8

#: Letters whose NFC form is the letter itself and whose lower case is one letter.
_LETTERS = "".join(c for c in map(chr, [*range(0x41, 0x7B), *range(0xC0, 0x100)]) if c.isalpha())
_STEM = re.compile(f"[{_LETTERS}]+")
#: ASCII marks that may end a word: in no contraction, in no special token, and a pre-token of their own.
_MARKS = ".,!?;:$&*%#"

#: The pre-tokenizer pattern of the word-end BPE file.
_WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def _encodes_words_alone(config: dict) -> bool:
    """Whether a text's ids are those of its white-space separated words, one after the other."""
    norm = [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", [])]
    pre = (config.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    split = pre[0]
    return (
        norm == ["NFC", "Replace", "Lowercase"]
        and split.get("type") == "Split"
        and split.get("pattern") == {"Regex": _WORD_PATTERN}
        and split.get("behavior") == "Removed"
        and split.get("invert") is True
        and [p.get("type") for p in pre[1:]] == ["ByteLevel"]
        and config.get("post_processor") is None
        and not any(re.search(r"\s", t["content"]) for t in config.get("added_tokens", []))
    )


class Encoder:
    """Token ids by the tokenizers library for the tokenizer in ``source`` (JSON text)."""

    def __init__(self, source: str):
        # A task has one core: the library's threads would take those of other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        self.by_word = _encodes_words_alone(json.loads(source))
        self.words: dict[str, bytes] = {}
        self.kept_bytes = 0
        if self.by_word:
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.byte_letters = {
                c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x100) if chr(c).isalpha()
            }
            # The same model for words that are spelled in its own alphabet already: cut at spaces, nothing else.
            self.bare = Tokenizer(self.library.model)
            self.bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocabulary, suffix = self.library.get_vocab(), self.library.model.end_of_word_suffix
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            if suffix:
                self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        usual = [t for t in texts if len(t) <= CHUNK]
        found = iter(self._by_words(usual) if self.by_word else self._plain(usual))
        return [
            next(found) if len(t) <= CHUNK else encode_spliced(self.library, t, CHUNK, OVERLAP) for t in texts
        ]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """Words are told apart by Arrow, and Python sees each of them once for all texts."""
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        ids = self._word_ids(coded.dictionary).take(coded.indices)
        _, edges, data = ids.buffers()
        at = np.frombuffer(edges, np.int64)[lists.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]

    def _word_ids(self, words: pa.Array) -> pa.Array:
        """The ids of each of these distinct words: those of plain letters and sentence marks from the ids of both, others whole."""
        stems, tails = pc.utf8_rtrim(words, characters=_MARKS), pc.utf8_ltrim(words, characters=_LETTERS)
        simple = pc.equal(pc.add(pc.binary_length(stems), pc.binary_length(tails)), pc.binary_length(words))
        parts = [pc.if_else(simple, pc.utf8_lower(stems), words).dictionary_encode(), pc.if_else(simple, tails, "").dictionary_encode()]
        # By way of numpy: to_pylist makes a scalar of each word first.
        keys = [p.dictionary.to_numpy(zero_copy_only=False).tolist() for p in parts]
        ids = self._known(keys[0] + keys[1])
        ids = [ids[: len(keys[0])], ids[len(keys[0]) :]]
        found = [pa.array(x, pa.large_binary()).take(p.indices) for x, p in zip(ids, parts)]
        return pc.binary_join_element_wise(*found, pa.scalar(b"", pa.large_binary()))

    def _known(self, keys: list[str]) -> list[bytes]:
        """The ids of each of these keys: lower-case stems, marks, and words of other kinds."""
        ids = list(map(self.words.get, keys))
        at = [i for i, x in enumerate(ids) if x is None]
        unseen = [keys[i] for i in at]
        if unseen and self.kept_bytes > KEPT_BYTES:
            # What these texts use is likely to be used again.
            self.words = {k: x for k, x in zip(keys, ids) if x is not None}
            self.kept_bytes = sum(map(len, self.words)) + len(self.words) * ENTRY_BYTES
        learnt = self._learn(unseen)
        for i, k in zip(at, unseen):
            ids[i] = learnt[k]
        kept = {k: x for k, x in learnt.items() if 0 < len(k) <= LONGEST_KEPT}
        self.words.update(kept)
        self.kept_bytes += sum(map(len, kept)) + len(kept) * ENTRY_BYTES
        return ids

    def _learn(self, unseen: list[str]) -> dict[str, bytes]:
        """The ids of stems and of anything else."""
        stems, other = [], []
        for k in unseen:
            (stems if (k.isalpha() if k.isascii() else _STEM.fullmatch(k)) else other).append(k)
        return dict(zip(other, self._plain(other))) | self._learn_stems(stems)

    def _learn_stems(self, stems: list[str]) -> dict[str, bytes]:
        """Stems of plain lower-case letters, many in one piece; the model marks the end of each."""
        spelled = [s if s.isascii() else s.translate(self.byte_letters) for s in stems]
        pieces = [" ".join(spelled[i : i + TOGETHER]) for i in range(0, len(spelled), TOGETHER)]
        found = [np.array(e.ids, "<u4") for e in self.bare.encode_batch_fast(pieces, add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        ends = (np.flatnonzero(self.ends_word[ids]) + 1).tolist()
        if len(ends) != len(stems) or (ends and ends[-1] != len(ids)):  # a model without such marks
            return dict(zip(stems, self._plain(stems)))
        data = ids.tobytes()
        return {s: data[4 * a : 4 * b] for s, a, b in zip(stems, [0, *ends], ends)}


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def encode_spliced(library, text: str, chunk: int, overlap: int) -> bytes:
    """The ids of ``text`` from chunks of ``chunk`` code points that overlap.

    Two neighbouring chunks are joined at a position where a white-space
    character follows another character (no pre-token of the supported
    tokenizers crosses it), which lies in both chunks, at which both have a
    token edge, and around which the tokens of both are the same with the same
    offsets. Where no position qualifies the overlap is doubled, at last up to
    the whole rest of the text, so the result is that of one ``encode``.
    """

    def encoded(a: int, b: int):
        e = library.encode(text[a:b], add_special_tokens=False)
        spans = np.array(e.offsets, dtype=np.int64).reshape(-1, 2) + a
        return np.array(e.ids, dtype="<u4"), spans

    out: list[bytes] = []
    start, begin = 0, 0  # text from `begin` on is still to be emitted; the chunk starts at `start`
    end = min(len(text), chunk + overlap)
    left = encoded(start, end)
    while end < len(text):
        wide = overlap
        while True:
            a = max(start, end - wide)
            b = min(len(text), a + wide + chunk)
            right = encoded(a, b)
            at = _common_edge(text, left, right, a, end, begin)
            if at is not None or (a == start and b == len(text)):
                break
            if a == start:  # the whole chunk is overlap already: lengthen it instead
                end = min(len(text), end + wide)
                left = encoded(start, end)
                if end == len(text):
                    break
            wide *= 2
        if at is None:
            break
        ids, spans = left
        out.append(ids[(spans[:, 0] >= begin) & (spans[:, 0] < at)].tobytes())
        start, begin, end, left = a, at, b, right
    ids, spans = left
    if end < len(text):  # nothing agrees anywhere: one encoding of all that is left
        ids, spans = encoded(start, len(text))
    out.append(ids[spans[:, 0] >= begin].tobytes())
    return b"".join(out)


def _common_edge(text: str, left, right, a: int, end: int, begin: int) -> int | None:
    """The last position in [a, end) proven to be a boundary for both encodings."""
    (li, ls), (ri, rs) = left, right
    middle = (a + end) // 2
    for at in sorted((i for i in range(max(a, begin) + 1, end) if text[i].isspace() and not text[i - 1].isspace()), key=lambda i: abs(i - middle))[:64]:
        lk, rk = int(np.searchsorted(ls[:, 0], at)), int(np.searchsorted(rs[:, 0], at))
        if (lk and ls[lk - 1, 1] > at) or (rk and rs[rk - 1, 1] > at):
            continue
        n = min(AGREE, lk, rk)
        m = min(AGREE, len(li) - lk, len(ri) - rk)
        if n < AGREE or m < AGREE:
            continue
        if (
            np.array_equal(li[lk - n : lk + m], ri[rk - n : rk + m])
            and np.array_equal(ls[lk - n : lk + m], rs[rk - n : rk + m])
        ):
            return at
    return None


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text, to be sent to the executors with a task (about 2 MB)."""
    with open(path, encoding="utf-8") as f:
        return f.read()


@lru_cache(maxsize=2)
def encoder(source: str) -> Encoder:
    """One encoder for each process and tokenizer; its word table lasts over tasks."""
    return Encoder(source)
