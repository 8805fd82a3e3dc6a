"""Order-preserving packing by dynamic programming.

The tokens of the documents of a partition form one stream. Cuts may fall at ends of documents (free), at ends of
sentences (a small penalty) or, where nothing else is near, between any two tokens (a larger penalty). The best cuts
minimise padding plus penalties: best(j) = pad + penalty(j) - p_j + min over p_j - size <= p_i < p_j of best(i) + p_i, whose
minimum over the sliding window a monotone queue keeps. A sequence whose length is a power of two needs no padding,
which adds one transition for each power.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store

SENTENCE, HARD, SEQUENCE = 24.0, 96.0, 16.0  # penalties in tokens; SEQUENCE: of each sequence, against needless short ones
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
MEMO = 200_000  # words of each of two generations that a Python worker holds, and parts of words
_state: dict[str, Words] = {}


# The steps before the model for which plain words are given to the model one by one (see Words).
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LOWER = "".join(c for c in map(chr, range(97, 0x17F)) if c.isalpha() and c.islower() and c.isascii() == (c <= "z") and c not in "ªµºŉ")
_LETTERS = _LOWER + "".join(c for c in map(chr, range(65, 0x17F)) if c.isalpha() and len(c.lower()) == 1 and c.lower() != c and c.lower() in _LOWER)
_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LOWER}]+|[0-9]|[^{_LOWER}0-9]+")
_PLAIN = re.compile(rf"[!-~{_LETTERS}]+")


class Words(dict):
    """Ids of words (pieces between blanks) of one tokenizer, as little-endian unsigned 32-bit bytes, with a memo.

    The library's normaliser and splitter take most of its time. For words of printable ASCII and composed Latin letters
    their result is known (lower case, split by the pattern), so each part goes straight to the library's model; all other
    words, and all words if the tokenizer's file describes other steps, take the library's whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tok = Tokenizer.from_file(path)
        self.parts: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        said = json.loads(self.tok.to_str())
        pre = said.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers") or [{}]
        self.known = (said.get("normalizer") or {}).get("normalizers") == NORMALIZER and steps[0].get("pattern") == {"Regex": SPLIT} and [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        chars = [*map(chr, range(33, 127)), *(c for c in _LOWER if not c.isascii())]
        self.bytes_of = str.maketrans({c: "".join(x for x, _ in self.tok.pre_tokenizer.pre_tokenize_str(c)) for c in chars}) if self.known else {}
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.firsts = {t[0] for t in self.special if t}

    def _part(self, part: str) -> bytes:
        got = self.parts.get(part)
        if got is None:
            tokens = self.tok.model.tokenize(part if part.isascii() else part.translate(self.bytes_of))
            got = self.parts[part] = array("I", [t.id for t in tokens]).tobytes()
        return got

    def __missing__(self, word: str) -> bytes:
        got = self.older.pop(word, None)
        if got is not None:
            self[word] = got
            return got
        if self.known and word.isascii() and word.isalpha():
            got = self._part(word.lower())
        elif self.known and _PLAIN.fullmatch(word) and (self.firsts.isdisjoint(word) or not any(t in word for t in self.special)):
            got = b"".join(map(self._part, _PARTS.findall(word.lower())))
        else:
            got = array("I", self.tok.encode(word, add_special_tokens=False).ids).tobytes()
        self[word] = got
        return got

    def trim(self) -> None:
        """With more than MEMO words, those not met since the last time are forgotten; with more parts, all of these."""
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()
        if len(self.parts) > MEMO:
            self.parts.clear()


def _tokenizer(path: str) -> Words:
    if path not in _state:
        _state[path] = Words(path)
    return _state[path]


def encode(texts: list[str], path: str) -> list[list[bytes]]:
    """For each text, the ids (as bytes) of each of its pieces between blanks and line ends.

    A tokenizer with the known steps drops white space and never joins across it, so the pieces' ids in order are the text's
    ids; only pieces that are not in the memo are given to it. Any other tokenizer takes each text whole, and an id belongs to
    the piece in which its token ends.
    """
    words = _tokenizer(path)
    words.trim()
    if not words.known:
        return [_whole(words.tok, t) for t in texts]
    return [list(map(words.__getitem__, t.replace("\n", " ").split(" "))) for t in texts]


def _whole(tok, text: str) -> list[bytes]:
    got = tok.encode(text, add_special_tokens=False)
    blanks = np.array([i for i, c in enumerate(text) if c in " \n"], np.int64)
    ends = np.maximum.accumulate(np.array([e for _, e in got.offsets], np.int64)) if got.offsets else np.zeros(0, np.int64)
    piece = np.searchsorted(blanks, ends - 1, "right")
    ids = np.array(got.ids, "<u4")
    edges = np.searchsorted(piece, np.arange(len(blanks) + 2))
    return [ids[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)]


_STOPS = np.zeros(256, bool)
_STOPS[[33, 46, 63]] = True


def by_sentence(text: str, pieces: list[bytes]) -> list[bytes]:
    """The ids of a text in runs, each up to an end of a sentence: a piece that ends in . or ! or ?, or the last piece."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    blank = np.flatnonzero((raw == 32) | (raw == 10))  # piece k ends at blank k
    cut = np.flatnonzero(_STOPS[raw[blank - 1]]) + 1
    if blank.size and blank[0] == 0 and cut.size and cut[0] == 1:
        cut = cut[1:]  # the first piece is empty
    bounds = [0, *cut.tolist(), len(pieces)]
    return [b"".join(pieces[a:b]) for a, b in zip(bounds, bounds[1:], strict=False) if a < b]


def _sorted_set(*parts: np.ndarray) -> np.ndarray:
    x = np.sort(np.concatenate(parts))
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if x.size else x


def best_cuts(position: np.ndarray, penalty: np.ndarray, size: int) -> list[int]:
    """Indexes of the chosen cuts among candidate positions (ascending from 0; gaps of at most size); the last is chosen."""
    n = len(position)
    # pairs of candidates that are a power of two apart: (later, earlier), by the later
    late, early = [], []
    for k in range(size.bit_length()):
        if 1 << k < size:
            at = np.searchsorted(position, position - (1 << k))
            hit = np.flatnonzero(position[at] == position - (1 << k))
            late.append(hit)
            early.append(at[hit])
    late, early = np.concatenate(late), np.concatenate(early)
    order = np.argsort(late, kind="stable")
    packed = lambda kind, x: array(kind, np.ascontiguousarray(x, np.float64 if kind == "d" else np.int64).tobytes())  # noqa: E731  8 bytes an entry
    late, early = packed("q", np.append(late[order], n)), packed("q", early[order])
    pos, pen = packed("q", position), packed("d", penalty + SEQUENCE)
    best, back = packed("d", np.zeros(n)), packed("q", np.zeros(n))
    keys, places, index = array("d", [0.0]), array("q", [0]), array("q", [0])  # the monotone queue, from head: best + position, position, candidate
    head = match = 0
    for j in range(1, n):
        p = pos[j]
        while places[head] < p - size:
            head += 1
        low, frm = keys[head] + size - p, index[head]
        while late[match] == j:
            k = early[match]
            match += 1
            if best[k] < low:
                low, frm = best[k], k
        low += pen[j]
        best[j], back[j] = low, frm
        low += p
        while len(keys) > head and keys[-1] >= low:
            keys.pop()
            places.pop()
            index.pop()
        keys.append(low)
        places.append(p)
        index.append(j)
    out, j = [], n - 1
    while j:
        out.append(j)
        j = back[j]
    return out[::-1]


def candidates(ends: np.ndarray, sentences: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut positions and penalties from ends of documents and of sentences; gaps over size / 8 get hard cuts, as does the tail."""
    total = int(ends[-1])
    soft = _sorted_set(np.zeros(1, np.int64), ends, sentences)
    gap = max(1, size // 8)
    wide = np.flatnonzero(np.diff(soft) > gap)
    hard = [np.arange(soft[i] + gap, soft[i + 1], gap) for i in wide]
    # what is left after whole sequences: the ends of blocks of falling powers of two, which need no padding
    tail, left = [], total % size
    for k in reversed(range(size.bit_length())):
        if left >> k & 1:
            left -= 1 << k
            tail.append(total - left)
    every = _sorted_set(soft, *hard, np.array([t for t in tail if 0 < t < total], np.int64), np.arange(size, total, size))
    penalty = np.full(len(every), HARD)
    penalty[np.searchsorted(every, sentences)] = SENTENCE
    penalty[np.searchsorted(every, ends)] = 0
    penalty[0] = 0
    return every, penalty


def pack_block(keys: list, ids: list[bytes], marks: list[np.ndarray], size: int, first: int) -> tuple[dict[str, list], int]:
    """Pieces of the documents of one block; marks: ends of sentences in tokens of each. Returns rows and the next sequence."""
    lengths = np.array([len(b) // 4 for b in ids], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    sentences = np.concatenate([m + s for m, s in zip(marks, starts, strict=True)]) if marks else np.zeros(0, np.int64)
    pos, pen = candidates(ends, sentences, size)
    cuts = pos[best_cuts(pos, pen, size)]
    seq_start = np.concatenate([[0], cuts[:-1]])
    piece_start = _sorted_set(starts, seq_start)
    piece_end = np.concatenate([piece_start[1:], ends[-1:]])
    doc = np.searchsorted(ends, piece_start, side="right")
    seq = np.searchsorted(cuts, piece_start, side="right")
    begin, stop = piece_start - starts[doc], piece_end - starts[doc]
    rows = {"doc_id": [keys[d] for d in doc], "start": begin, "length": stop - begin, "ids_crc32": [zlib.crc32(ids[d][4 * a : 4 * b]) for d, a, b in zip(doc, begin, stop, strict=True)], "doc_tokens": lengths[doc], "sequence_id": first + seq, "offset": piece_start - seq_start[seq]}
    return rows, first + len(cuts)


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 2, key: str = "doc_id", text: str = "text", block_tokens: int = 4_000_000) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents, in partition order.

    Each partition is packed on its own in blocks of about block_tokens tokens, so memory is bounded by a block or one
    document; at the end of a block what fills no sequence is cut at powers of two. sequence_id: the partition's number
    times 2**33 and a running number. A null or empty text is the end id alone; repeated rows are each packed; a null
    key stays null. tokenizer: path of a tokenizers file on every executor.
    """
    store.small_batches(docs.sparkSession)
    tail = array("I", [end_id]).tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        keys, ids, marks, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, keys, ids, marks, held
            rows, number = pack_block(keys, ids, marks, size, number)
            keys, ids, marks, held = [], [], [], 0
            return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in rows.items()})

        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for at in range(0, b.num_rows, 512):
                part = [t or "" for t in texts.slice(at, 512).to_pylist()]
                for k, t, pieces in zip(names[at : at + 512], part, encode(part, tokenizer), strict=True):
                    runs = by_sentence(t, pieces) if t else []
                    whole = b"".join(runs) + tail
                    mark = np.cumsum(np.fromiter(map(len, runs[:-1]), np.int64, max(0, len(runs) - 1))) // 4
                    keys.append(k)
                    ids.append(whole)
                    marks.append(mark)
                    held += len(whole) // 4
                    if held >= block_tokens:
                        yield flush()
        if keys:
            yield flush()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text)).mapInArrow(work, SCHEMA)
