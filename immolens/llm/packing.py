"""Harmonic packing of token sequences.

A piece of ``n`` ids belongs to class ``k = seq_len // n``, that is, its
length lies in ``(seq_len/(k+1), seq_len/k]``, and a sequence of class ``k``
holds exactly ``k`` pieces. Each task fills the sequences of every class on
its own, in one pass over its rows: there is no shuffle, and no state other
than one open sequence per class (``seq_len`` classes of less than
``seq_len`` ids each).

Padding is kept small by cutting: a document gives full sequences first; a
rest whose class would waste more than ``slack`` of a sequence gives up a
head of ``seq_len // (k+1)`` ids, which fills its class without loss, and the
tail is classed again (it is shorter than ``seq_len / (k(k+1))``, so a few
cuts suffice). When a task's rows end, the pieces of its open sequences are
laid end to end and cut at sequence ends; what is left over gives sequences
whose lengths are powers of two, so no padding is left there either.

Cases: null or empty text: one piece, the end id. A document longer than a
sequence: cut. Null ids, repeated rows and ties: each row is packed on its
own. An empty table gives no rows. Other columns are ignored. The result is
a function of the rows of each input partition and their order; write an
input whose order is not fixed (after a shuffle) before packing it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from immolens.llm.memory import thrifty
from immolens.llm.tokens import encoder, tokenizer_path

SEQ_LEN = 2048
END_ID = 1
SLACK = 1 / 32

_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_FLUSH_ROWS, _FLUSH_BYTES = 8192, 8 << 20
_BATCH_CHARS = 4 << 20


def cut_lengths(n: int, seq_len: int, slack: float = SLACK) -> list[int]:
    """Piece lengths of a document of ``n`` ids."""
    cuts = [seq_len] * (n // seq_len)
    rest = n % seq_len
    while rest:
        k = seq_len // rest
        if k * rest >= seq_len * (1 - slack):
            cuts.append(rest)
            break
        head = seq_len // (k + 1)
        cuts.append(head)
        rest -= head
    return cuts


class HarmonicBins:
    """Open sequences of one task; ``add`` returns a sequence when it is full.
    A piece is ``(doc_id, start, ids, doc_tokens)``."""

    def __init__(self, seq_len: int):
        self.seq_len = seq_len
        self.open: dict[int, list] = {}

    def add(self, piece) -> list | None:
        k = self.seq_len // len(piece[2])
        filled = self.open.setdefault(k, [])
        filled.append(piece)
        if len(filled) == k:
            return self.open.pop(k)
        return None

    def rest(self) -> Iterator[list]:
        """The open sequences' pieces, laid end to end."""
        sequence, room = [], self.seq_len
        for k in sorted(self.open):
            for doc, start, ids, total in self.open[k]:
                while len(ids):
                    part = ids[:room]
                    sequence.append((doc, start, part, total))
                    start, ids, room = start + len(part), ids[len(part):], room - len(part)
                    if not room:
                        yield sequence
                        sequence, room = [], self.seq_len
        self.open = {}
        yield from _powers_of_two(sequence)


def _powers_of_two(pieces: list) -> Iterator[list]:
    """The pieces of a partly filled sequence as sequences whose lengths are
    the powers of two that make up its length."""
    left = sum(len(p[2]) for p in pieces)
    queue = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        left -= size
        sequence = []
        while size:
            doc, start, ids, total = queue.pop()
            part = ids[:size]
            sequence.append((doc, start, part, total))
            size -= len(part)
            if len(part) < len(ids):
                queue.append((doc, start + len(part), ids[len(part):], total))
        yield sequence


def pack(docs: DataFrame, seq_len: int = SEQ_LEN, end_id: int = END_ID, tokenizer: str | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Training sequences: one row per piece with its ids (little-endian
    unsigned 32-bit), the sequence it lies in and its offset there."""
    path = tokenizer or tokenizer_path()

    @thrifty
    def pack_partition(batches):
        bins = HarmonicBins(seq_len)
        enc = encoder(path)
        task = TaskContext.get()
        next_id = (task.partitionId() if task else 0) << 33
        rows: list[tuple] = []
        size = 0

        def put(sequence):
            nonlocal next_id, size
            offset = 0
            for doc, start, ids, total in sequence:
                rows.append((doc, start, len(ids), ids.tobytes(), total, next_id, offset))
                offset += len(ids)
            size += 4 * offset
            next_id += 1

        def out():
            nonlocal size
            batch = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)
            rows.clear()
            size = 0
            return batch

        for batch in batches:
            for doc_ids, texts in _slices(batch):
                for doc, ids in zip(doc_ids, enc.encode(texts)):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    start = 0
                    for n in cut_lengths(len(ids), seq_len):
                        if (full := bins.add((doc, start, ids[start:start + n], len(ids)))) is not None:
                            put(full)
                        start += n
                    if len(rows) >= _FLUSH_ROWS or size >= _FLUSH_BYTES:
                        yield out()
        for sequence in bins.rest():
            put(sequence)
            if len(rows) >= _FLUSH_ROWS or size >= _FLUSH_BYTES:
                yield out()
        if rows:
            yield out()

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .mapInArrow(pack_partition, _SCHEMA))


_NAMES = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, a bounded number of characters at a time."""
    ids, texts, size = [], [], 0
    for doc, text in zip(batch.column(0), batch.column(1)):
        ids.append(doc.as_py())
        texts.append(text.as_py())
        size += len(texts[-1])
        if size >= _BATCH_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if texts:
        yield ids, texts


def packed_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
