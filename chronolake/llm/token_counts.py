"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are split at safe boundaries: places where the pre-tokenizer of the byte-level vocabularies
always ends one word and starts the next, so that the counts of the parts add up to the count of the
text. Parts met before are counted from memory; the others go to the tokenizer in batches of about
equal bytes, so that a long text neither inflates a call nor delays the others.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .words import chunks

#: Bytes of a call to the tokenizer; parts remembered by a task, and their longest length.
CALL_BYTES = 1 << 18
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 64
#: White space of the pre-tokenizer.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A part is a word with the space before it, a single other white space between words, or words around runs of
#: white space. No part ends inside such a run, and special strings hold no white space.
PART = re.compile(rf" ?[^{SPACES}]+(?:[{SPACES}]{{2,}}[^{SPACES}]+)*|[{SPACES}]{{2,}}[^{SPACES}]+(?:[{SPACES}]{{2,}}[^{SPACES}]+)*|[{SPACES}]+")
#: Inside long parts: the pre-tokenizer ends a word between a mark other than an apostrophe and a letter or digit.
INNER = re.compile(r"""(?<=[.,;:!?()\[\]{}"、。，；：？！」』）】》])(?=[A-Za-z0-9一-鿿ぁ-ゖァ-ヺ가-힣])""")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def parts_of(text: str, special: tuple[str, ...] = ("<|endoftext|>",)) -> list[str]:
    """Parts of a text whose token counts add up to its own. special: strings that the tokenizer takes whole."""
    parts = PART.findall(text)
    if len(text) <= REMEMBERED_CHARS or max(map(len, parts), default=0) <= REMEMBERED_CHARS:
        return parts
    out = []
    for part in parts:
        if len(part) <= REMEMBERED_CHARS or any(s in part for s in special):
            out.append(part)
        else:
            out.extend(INNER.split(part))
    return out


class Counts(dict):
    """Token counts of parts by a tokenizer; ask for new parts in batches with learn()."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer

    def learn(self, parts: set[str]) -> None:
        call, held = [], 0
        for part in parts:
            call.append(part)
            held += len(part.encode())
            if held >= CALL_BYTES:
                self.encode(call)
                call, held = [], 0
        self.encode(call)

    def encode(self, call: list[str]) -> None:
        for part, e in zip(call, self.tokenizer.encode_batch_fast(call, add_special_tokens=False)):
            self[part] = len(e)

    def forget_long(self, parts: set[str]) -> None:
        for part in parts:
            if len(part) > REMEMBERED_CHARS:
                self.pop(part, None)


def counter(path: str):
    """A function for mapInArrow: (doc_id, text) to (doc_id, n_bytes, n_tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, "rb") as f:
            tokenizer = Tokenizer.from_buffer(f.read())
        tokenizer.no_truncation()
        tokenizer.no_padding()
        counts = Counts(tokenizer)
        special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                split = [parts_of(t, special) if t else [] for t in batch.column("text").slice(lo, hi - lo).to_pylist()]
                if len(counts) > REMEMBERED:
                    counts.clear()
                new = {p for parts in split for p in parts if p not in counts}
                counts.learn(new)
                n_tokens = [sum(map(counts.__getitem__, parts)) for parts in split]
                counts.forget_long(new)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(n_tokens, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 1024) -> DataFrame:
    """Tokens of every whole text, without begin, end or added tokens.

    docs: doc_id long, text string; more columns are ignored. Null and empty texts count 0 bytes and
    0 tokens; repeated rows give repeated rows; an empty table gives an empty result.
    Returns doc_id, n_bytes, n_tokens, over_limit (more tokens than limit).
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = slim.mapInArrow(counter(path or vocabulary()), "doc_id long, n_bytes long, n_tokens long")
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
