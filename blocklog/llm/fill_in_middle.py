"""Fill-in-middle transformation by secondary sort (operator 11).

A document's units (code points) are cut at two hashed places and put out as prefix, suffix and middle with sentinels
between. No task builds an output or a restored text from parts held together:

1. `infill_pieces` emits chunks of units, sentinels included, keyed by document and position in the output;
2. the pieces are dealt by document and sorted by position within the partition (one shuffle, the only one), and stream
   into an incremental digest of the output (`assemble`);
3. the stream is parsed for sentinels again, which needs the text and the form only; what is found is sorted anew
   within the partition by its place in the document, and streams into the digest of the restored text (`restore`).

The second sort needs no shuffle, as all pieces of a document are in one partition already. A piece is `UNITS` code
points at most, so a sort can spill and a digest holds one piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SENTINELS = (PREFIX, SUFFIX, MIDDLE)
#: Percent of the documents that are rearranged, and of those, that have the suffix first.
RATE, SUFFIX_FIRST = 90, 20
#: Code points of a piece at most.
UNITS = 1 << 12
#: Bytes of pieces that are handed on at once.
_BATCH = 1 << 22

#: `doc_id` and `print`, a hash of the text, name a document; `copies` is the number of equal rows behind a piece.
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("print", pa.int64()), ("position", pa.int64()), ("piece", pa.string()), ("copies", pa.int64()),
        ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ]
)
_HEADER = [f.name for f in _PIECES][4:]
_DDL = {pa.int64(): "bigint", pa.string(): "string", pa.int32(): "int"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def cuts(doc_id: int | None, n: int, has_sentinel: bool) -> tuple[str, int | None, int | None]:
    """Form, units of the prefix and units of the middle of a document of n units; a null id is written as empty."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if n == 0 or has_sentinel or h3 % 100 >= RATE:
        return "plain", None, None
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    return "spm" if h4 % 100 < SUFFIX_FIRST else "psm", low, high - low


def _parts(text: str, form: str, prefix: int | None, middle: int | None) -> list[tuple[int, int] | str]:
    """The output in order: stretches of the text and sentinels."""
    if form == "plain":
        return [(0, len(text))]
    end = prefix + middle
    ahead, behind = [PREFIX, (0, prefix)], [SUFFIX, (end, len(text))]
    return [*(ahead + behind if form == "psm" else behind + ahead), MIDDLE, (prefix, end)]


def _chunks(text: str, form: str, prefix: int | None, middle: int | None, units: int) -> Iterator[tuple[int, str]]:
    """(position in the output, piece); an empty output is one empty piece."""
    at = 0
    for part in _parts(text, form, prefix, middle):
        start, end = (0, len(part)) if isinstance(part, str) else part
        source = part if isinstance(part, str) else text
        for k in range(start, end, units):
            piece = source[k : min(k + units, end)]
            yield at, piece
            at += len(piece)
    if at == 0:
        yield 0, ""


class _Rows:
    """Collects rows and hands them on as record batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self._schema, self._rows, self._size = schema, [], 0

    def add(self, row: tuple, size: int) -> bool:
        self._rows.append(row)
        self._size += size + 64
        return self._size >= _BATCH

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self._rows)) or [()] * len(self._schema)
        self._rows, self._size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self._schema, strict=True)], schema=self._schema)


def _emit_pieces(units: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_PIECES)
        for batch in batches:
            ids, prints, texts = (batch.column(k) for k in range(3))
            keys = list(zip(ids.to_pylist(), prints.to_pylist(), strict=True))
            copies: dict[tuple, int] = {}
            for key in keys:
                copies[key] = copies.get(key, 0) + 1
            for k, key in enumerate(keys):
                times = copies.pop(key, None)  # equal rows of a batch go out once
                if times is None:
                    continue
                text = texts[k].as_py()
                form, prefix, middle = cuts(key[0], len(text), any(s in text for s in _SENTINELS))
                for position, piece in _chunks(text, form, prefix, middle, units):
                    if out.add((*key, position, piece, times, len(text), form, prefix, middle), len(piece)):
                        yield out.take()
        yield out.take()

    return run


def infill_pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", units: int = UNITS) -> DataFrame:
    """Chunks of the transformed texts with their positions, unordered.

    A null text counts as empty and gives one empty piece. Equal rows (id and text) may share their pieces and say so in
    `copies`; rows with one id and different texts are different documents. Other columns are left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint"), F.xxhash64(text), text).mapInArrow(_emit_pieces(units), _ddl(_PIECES))


def _documents(batches: Iterator[pa.RecordBatch], order: tuple[str, ...], summed: str) -> Iterator[tuple[dict, bool]]:
    """Rows in order with whether they begin a document; a row repeated by copies comes once, copies added to `summed`.

    Rows are `order`ed within a document, so copies of a row follow each other. Copies are known in full only when the
    next row comes, so one row is held back.
    """
    held, first = None, True
    for row in (row for batch in batches for k in range(0, batch.num_rows, 256) for row in batch.slice(k, 256).to_pylist()):
        if held is not None:
            same = row["doc_id"] == held["doc_id"] and row["print"] == held["print"]
            if same and all(row[c] == held[c] for c in order):
                held[summed] += row[summed]
                continue
            yield held, first
            first = not same
        held = row
    if held is not None:
        yield held, first


#: Section and place in it order the pieces of the document itself; section -1 is the head that carries the digest.
_SECTIONS = pa.schema([*list(_PIECES)[:2], ("section", pa.int32()), ("place", pa.int64()), ("text", pa.string()), *list(_PIECES)[4:], ("output_sha256", pa.string()), ("output", pa.string())])


class _Splitter:
    """Finds the sections of an output that arrives in pieces; the sentinels may lie across pieces."""

    _SECTION = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

    def __init__(self, plain: bool):
        self._plain, self._carry, self._section, self._place = plain, "", 0, 0

    def feed(self, piece: str, last: bool) -> Iterator[tuple[int, int, str]]:
        text, self._carry = self._carry + piece, ""
        while not self._plain:
            at, mark = min(((k, s) for s in _SENTINELS if (k := text.find(s)) >= 0), default=(-1, ""))
            if at < 0:
                break
            yield from self._out(text[:at])
            text, self._section, self._place = text[at + len(mark) :], self._SECTION[mark], 0
        if not last and not self._plain:  # the beginning of a sentinel may be at the end
            text, self._carry = text[:-2], text[-2:]
        yield from self._out(text)

    def _out(self, text: str) -> Iterator[tuple[int, int, str]]:
        if text:
            yield self._section, self._place, text
            self._place += len(text)


def _assemble(keep_output: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(_SECTIONS)
        head, digest, splitter, whole = None, None, None, []
        blank = (None,) * len(_HEADER)

        def sections(piece: str, last: bool) -> Iterator[bool]:
            for section, place, text in splitter.feed(piece, last):
                yield out.add((head["doc_id"], head["print"], section, place, text, *blank, None, None), len(text))

        def close() -> bool:
            text = "".join(whole) if keep_output else None
            row = (head["doc_id"], head["print"], -1, 0, None, *(head[c] for c in _HEADER), digest.hexdigest(), text)
            return out.add(row, len(text or ""))

        for row, first in _documents(batches, ("position",), "copies"):
            if first:
                if head is not None:
                    for full in (*sections("", True), close()):
                        if full:
                            yield out.take()
                head, digest, splitter, whole = row, hashlib.sha256(), _Splitter(row["form"] == "plain"), []
            digest.update(row["piece"].encode())
            if keep_output:
                whole.append(row["piece"])
            for full in sections(row["piece"], False):
                if full:
                    yield out.take()
        if head is not None:
            list(sections("", True))
            close()
        yield out.take()

    return run


def assemble(pieces: DataFrame, *, keep_output: bool = False) -> DataFrame:
    """One head row for each document with the digest of its output, and rows with the sections parsed from that.

    Partitioned by document. `keep_output` also joins the pieces to the whole output, one document at a time.
    """
    dealt = pieces.repartition("doc_id", "print").sortWithinPartitions("doc_id", "print", "position")
    return dealt.mapInArrow(_assemble(keep_output), _ddl(_SECTIONS))


_RESULT = pa.schema([("doc_id", pa.int64()), *list(_PIECES)[5:], ("output_sha256", pa.string()), ("restored_sha256", pa.string()), ("output", pa.string())])


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = _Rows(_RESULT)
    head, digest = None, None

    def close() -> Iterator[bool]:
        row = (*(head[c] for c in ("doc_id", *_HEADER[1:], "output_sha256")), digest.hexdigest(), head["output"])
        for _ in range(head["copies"]):
            yield out.add(row, len(head["output"] or ""))

    for row, first in _documents(batches, ("section", "place"), "copies"):
        if first:
            if head is not None:
                for full in close():
                    if full:
                        yield out.take()
            head, digest = row, hashlib.sha256()
        else:
            digest.update(row["text"].encode())
    if head is not None:
        for full in close():
            if full:
                yield out.take()
    yield out.take()


def restore(sections: DataFrame) -> DataFrame:
    """The documents of `assemble` with the digest of the text that their sections make when sorted back."""
    return sections.sortWithinPartitions("doc_id", "print", "section", "place").mapInArrow(_restore, _ddl(_RESULT))


def fill_in_middle(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", units: int = UNITS, keep_output: bool = True) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, output) of each row.

    A text is plain if it is empty, has a sentinel in it, or by its id's hash; then the counts are null. A null text counts
    as empty, a null id is hashed as empty. Repeated rows give repeated rows, an empty table gives none. Other columns are
    left out, whatever their names. `output` is null unless `keep_output`.
    """
    return restore(assemble(infill_pieces(docs, id_col=id_col, text_col=text_col, units=units), keep_output=keep_output))
