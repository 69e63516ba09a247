"""Hierarchical multi-length packing of tokenised documents (operator 3).

A task tokenises its documents and packs them in blocks of a bounded number of tokens, so nothing is shuffled
and no group of documents meets in one task. In a block

1. whole long windows are cut from the front of long documents, and what is left of each document is routed to
   the shortest tier that holds it;
2. each tier, from the longest, opens one window for each of its pieces and fills the gap with pieces of shorter
   tiers, the largest that fits first; where none fits, a piece is cut;
3. a last window that nothing is left to fill is cut at powers of two, so it needs no padding;
4. sequences of one length are dealt into step groups of equal numbers of tokens.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
TIERS = (1024, 512, 256, 128)
#: Tokens that a task holds before it packs them.
BLOCK_TOKENS = 2_000_000
#: Tokens of a step group.
STEP_TOKENS = 8192
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, tier bigint, step_group bigint"
)
_ARROW = pa.schema([(name.split()[0], pa.int64()) for name in SCHEMA.split(", ")])

#: What the byte-level pre-tokenizer of the vocabulary splits a text into.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones stand for themselves."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit numbers.

    Reads a byte-level BPE vocabulary in the format of `tokenizers` and gives the ids which that library gives for
    the whole text without adding special tokens; the merging is left to `tiktoken`, which takes a sixth of the
    time. The strings of special tokens in a text become their ids, as in `tokenizers`.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        special = {t["content"]: t["id"] for t in described["added_tokens"]}
        byte = _byte_of()
        ranks = {bytes(map(byte.__getitem__, t)): i for t, i in described["model"]["vocab"].items() if t not in special}
        self._bpe = tiktoken.Encoding(path, pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> bytes:
        return self._bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


class _Block:
    """Pieces (document, start, length) of the sequences of one block."""

    def __init__(self, window: int, tiers: tuple[int, ...]):
        self.window, self.tiers = window, tiers
        self.sequences: list[list[tuple[int, int, int]]] = []
        self.pool: list[tuple[int, int, int]] = []  # (length, document, start), ascending

    def add(self, doc: int, tokens: int) -> None:
        whole = tokens // self.window
        self.sequences += [[(doc, k * self.window, self.window)] for k in range(whole)]
        if rest := tokens - whole * self.window:
            self.pool.append((rest, doc, whole * self.window))

    def _fill(self, size: int, shorter: int) -> list[tuple[int, int, int]]:
        """One window of `size` that begins with the largest piece; less than `size` if the pool runs out."""
        length, doc, start = self.pool.pop()
        window, gap = [(doc, start, length)], size - length
        while gap and self.pool:
            fits = bisect_right(self.pool, (min(gap, shorter), float("inf"))) - 1
            if fits >= 0:
                length, doc, start = self.pool.pop(fits)
                window.append((doc, start, length))
                gap -= length
            else:
                length, doc, start = self.pool.pop(0)
                window.append((doc, start, gap))
                insort(self.pool, (length - gap, doc, start + gap))
                gap = 0
        return window

    def pack(self) -> list[list[tuple[int, int, int]]]:
        self.pool.sort()
        tiers = sorted(self.tiers, reverse=True)
        for size, shorter in zip(tiers, [*tiers[1:], 0], strict=True):
            while self.pool and self.pool[-1][0] > shorter:
                window = self._fill(size, shorter or size)
                if sum(p[2] for p in window) == size:
                    self.sequences.append(window)
                else:
                    self._cut(window)
        return self.sequences

    def _cut(self, window: list[tuple[int, int, int]]) -> None:
        """Sequences whose lengths are the powers of two that make up the window's length."""
        left = sum(p[2] for p in window)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            sequence = []
            while size:
                doc, start, length = window[0]
                take = min(size, length)
                sequence.append((doc, start, take))
                size -= take
                window[0:1] = [(doc, start + take, length - take)] if take < length else []
            self.sequences.append(sequence)


def _rows(docs: list[tuple[int | None, bytes]], first: int, group: int, window: int, tiers, step_tokens: int):
    """The pieces of a block, and how many sequences and step groups it has."""
    block = _Block(window, tiers)
    for k, (_, ids) in enumerate(docs):
        block.add(k, len(ids) // 4)
    sequences = sorted(block.pack(), key=lambda s: -sum(p[2] for p in s))
    columns: list[list] = [[] for _ in _ARROW]
    held, size = 0, 0
    for k, sequence in enumerate(sequences):
        length = sum(p[2] for p in sequence)
        if held and (length != size or held + length > step_tokens):
            group, held = group + 1, 0
        held, size, offset = held + length, length, 0
        for doc, start, n in sequence:
            doc_id, ids = docs[doc]
            row = (doc_id, start, n, zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)]), len(ids) // 4, first + k, offset, length, group)
            for column, value in zip(columns, row, strict=True):
                column.append(value)
            offset += n
    return columns, len(sequences), group + 1


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    tiers: tuple[int, ...] = TIERS,
    block_tokens: int = BLOCK_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence.

    A document's ids are the tokenizer's without special tokens, then id 0. Each id lies in one piece; sequences
    hold a power of two of ids, `window` at most, and need no padding. `tier` is the length of the sequence and
    `step_group` the group it is trained in; both ids are unique over the whole table but not dense.

    A null text counts as empty (one id); a null id stays null; repeated rows are packed once each; an empty table
    gives no rows; other columns are not read. `window` and `tiers` must be powers of two.
    """
    sizes = tuple(sorted({window, *(t for t in tiers if t < window)}, reverse=True))
    if any(s & (s - 1) for s in sizes):
        raise ValueError("window and tiers must be powers of two")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path)
        base = TaskContext.get().partitionId() << 40
        state = [0, 0]
        docs_held: list[tuple[int | None, bytes]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns, n, group = _rows(docs_held, base + state[0], base + state[1], window, sizes, step_tokens)
            state[0], state[1] = state[0] + n, group - base
            docs_held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py() or "")
                docs_held.append((doc_id.as_py(), ids + b"\0\0\0\0"))
                held += len(ids) // 4 + 1
                if held >= block_tokens:
                    yield flush()
                    held = 0
        if docs_held:
            yield flush()

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(pack, SCHEMA)
