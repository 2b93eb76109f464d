"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The given vocabulary is a BPE model, whose ids a plain best-sum Viterbi path does not give. The
pass therefore keeps Viterbi's lattice, backpointers and bounded window, and decides which arc
survives at a boundary by the model's own merges: among the pieces that end there, the one that
stays unmerged next to the last piece of the path it extends. Each boundary has exactly one such
arc, so the path equals the library's encoding. The window is the longest piece; when all
backpointer paths from the window meet in one boundary, the ids before it are committed and their
states dropped, so memory is bounded for texts of any length.

Texts stream through the pass in cuts of a few windows. Words are independent where no piece spans a
space: a word of up to REMEMBERED_CHARS is looked up first, and passed only when it is new.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .token_counts import vocabulary

SPACE = "▁"
#: Words and pairs of pieces remembered by a task, and the longest length of a word.
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 64
#: Windows of a cut of a long word; characters of a section of a text, which ends where a word does.
CUT_WINDOWS, SECTION = 16, 1 << 20
WORD_END = re.compile("(?<=[^ ]) ")


class Pieces:
    """A SentencePiece BPE vocabulary with byte fallback."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids = [sp.unk_id()] * 256
        self.raw: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i):
                self.raw.append(b"")
            elif sp.is_unknown(i):
                self.raw.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.raw.append(piece.replace(SPACE, " ").encode())
        self.window = max(map(len, self.ids))
        self.trie: dict = {}
        for piece in self.ids:
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = piece
        #: Whether pieces may span words, so that a text is one.
        self.whole = False
        self.words = self.independent()
        self.pairs: dict[str, dict[str, bool]] = {}
        self.held = 0

    def independent(self) -> re.Pattern:
        """Parts of a text that no piece spans: words with the spaces before them, and newlines."""
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            self.whole = True
            return re.compile(".+", re.S)
        if any("\n" in p for p in self.ids):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        return re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best neighbours, the leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stays(self, left: str, right: str) -> bool:
        """Whether two pieces next to each other stay as they are."""
        return self.merged(left + right) == ([left, right] if left else [right])

    def extend(self, text: str, last: list[str | None], at: int, stop: int) -> None:
        """Extend the paths to the boundaries from at to stop - 1 by all pieces that start there.

        last[i] is the piece that ends the path to boundary i, None while no piece has reached it.
        """
        n, trie, pairs = len(text), self.trie, self.pairs
        while at < stop:
            left = last[at]
            known = pairs.get(left)
            if known is None:
                known = pairs[left] = {}
            node, j = trie, at
            while j < n:
                node = node.get(text[j])
                if node is None:
                    break
                j += 1
                piece = node.get("")
                if piece is not None:
                    ok = known.get(piece)
                    if ok is None:
                        ok = known[piece] = self.stays(left, piece)
                        self.held += 1
                    if ok:
                        last[j] = piece
            at += 1
            if last[at] is None:
                last[at] = text[at - 1]

    def path(self, parts: Iterable[str]) -> Iterator[list[str]]:
        """Pieces of a text that arrives in parts, in runs committed as soon as all surviving paths meet.

        Only what is not committed yet is kept, so short parts make the work linear in the text.
        """
        text, last, at, step = "", [""], 0, 4 * self.window
        for part, final in _marked(parts):
            text += part
            last.extend([None] * len(part))
            if self.held > REMEMBERED:
                self.pairs.clear()
                self.held = 0
            while True:
                stop = len(text) if final else max(at, len(text) - self.window + 1)
                upto = min(stop, at + step)
                self.extend(text, last, at, upto)
                at = upto
                if at == stop:
                    break
                meet = self.meeting(last, at)
                if meet:
                    yield self.back(last, meet)
                    text, last, at = text[meet:], last[meet:], at - meet
        yield self.back(last, len(last) - 1)

    def cuts(self, word: str) -> Iterator[str]:
        """A word in cuts of a few windows."""
        size = CUT_WINDOWS * self.window
        return (word[k : k + size] for k in range(0, len(word), size))

    @staticmethod
    def meeting(last: list[str | None], at: int) -> int:
        """The last boundary that the paths to at and to all boundaries reached beyond it have in common."""
        alive = {i for i in range(at, len(last)) if last[i] is not None}
        while len(alive) > 1:
            top = max(alive)
            alive.remove(top)
            alive.add(top - len(last[top]))
        return alive.pop()

    @staticmethod
    def back(last: list[str], at: int) -> list[str]:
        out = []
        while at > 0:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def to_ids(self, path: Iterable[list[str]]) -> array:
        """Ids of the runs of a path."""
        out, ids = array("i"), self.ids
        for run in path:
            for piece in run:
                i = ids.get(piece)
                if i is not None:
                    out.append(i)
                else:
                    out.extend(self.byte_ids[b] for b in piece.encode())
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; the space that encoding puts in front goes."""
        raw = self.raw
        text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _marked(parts: Iterable[str]) -> Iterator[tuple[str, bool]]:
    """Each part, with whether it is the last; an empty last part ends a text of no parts."""
    held = None
    for part in parts:
        if held is not None:
            yield held, False
        held = part
    yield held or "", True


class Remembered(dict):
    """Packed ids of each word that was met."""

    def __init__(self, model: Pieces) -> None:
        self.model = model

    def __missing__(self, word: str) -> bytes:
        ids = self.model.to_ids(self.model.path(self.model.cuts(word))).tobytes()
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = ids
        return ids


def sections(text: str, whole: bool) -> Iterator[str]:
    """A text in sections that end where a word does; whole: in one."""
    at = 0
    while at < len(text):
        end = None if whole else WORD_END.search(text, at + SECTION)
        upto = end.start() if end else len(text)
        yield text[at:upto]
        at = upto


def encode(model: Pieces, memory: Remembered, text: str) -> np.ndarray:
    """Ids of a whole text."""
    out, lead = [], SPACE
    for section in sections(text, model.whole):
        words = model.words.findall(lead + section.replace(" ", SPACE))
        out.append(b"".join(map(memory.__getitem__, words)))
        lead = ""
    return np.frombuffer(b"".join(out), np.int32)


def encoder(path: str):
    """A function for mapInArrow: (doc_id, text) to (doc_id, n_tokens, ids, round_trip)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(path, "rb") as f:
            model = Pieces(f.read())
        memory = Remembered(model)
        for batch in batches:
            docs, ids, same, held = [], [], [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                own = encode(model, memory, text)
                docs.append(doc_id)
                ids.append(own)
                same.append(model.decode(own.tolist()) == text)
                held += len(own)
                if held > 1 << 20:
                    yield _rows(docs, ids, same)
                    docs, ids, same, held = [], [], [], 0
            if docs:
                yield _rows(docs, ids, same)

    return run


def _rows(docs: list, ids: list[np.ndarray], same: list[bool]) -> pa.RecordBatch:
    size = np.array([len(x) for x in ids], np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(np.concatenate(ids)))
    return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(size), lists, pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "round_trip"])


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Ids of every whole text, as the library gives them, and whether they decode to the text.

    docs: doc_id long, text string; more columns are ignored. Null and empty texts give an empty list
    and round_trip true; repeated rows give repeated rows; an empty table gives an empty result.
    Returns doc_id, n_tokens, ids, round_trip.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(encoder(path or vocabulary("piece_bpe_32k.model")), "doc_id long, n_tokens long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Texts of id lists. encoded: doc_id, ids; null lists give empty texts. Returns doc_id, text."""
    where = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(where, "rb") as f:
            model = Pieces(f.read())
        for batch in batches:
            texts = [model.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
