"""Cost-balanced packing of tokenised documents into sequences of a fixed size."""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import slices

SEQUENCE = 1024
END_ID = 0
#: Tokens that a task packs together; bounds its memory whatever the partition holds.
WINDOW_TOKENS = 1 << 20
#: Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n (attention within a piece).
LINEAR, QUADRATIC = 1.0, 1.0 / 512
RANKS = "byte_bpe_50k.tiktoken"
FILE = "byte_bpe_50k.json"
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, cost double"

_encoders: dict = {}


def encoder(path: str, added_as_text: bool = False):
    """A function from a text to its ids under the byte-level vocabulary at ``path``.

    The ids are those of ``tokenizers`` with the json file. Where the rank file of the same vocabulary lies beside it,
    ``tiktoken`` finds them about four times as fast; texts with characters that the two libraries could sort into
    different classes (beyond the first 0x500 code points) go through ``tokenizers``. The strings of the file's added tokens
    are their ids wherever they stand, as the file has it, or ordinary text with ``added_as_text``.
    """
    if (path, added_as_text) in _encoders:
        return _encoders[path, added_as_text]
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    exact.encode_special_tokens = added_as_text
    added = [] if added_as_text else [t.content for t in exact.get_added_tokens_decoder().values()]
    ranks_file = path.removesuffix(FILE) + RANKS
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_file, "rb"))}
    quick = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if (not text or text.isascii() or max(text) < "Ԁ") and not any(a in text for a in added):
            return quick.encode_ordinary(text)
        return exact.encode(text, add_special_tokens=False).ids

    _encoders[path, added_as_text] = encode
    return encode


def cost(n):
    return LINEAR * n + QUADRATIC * n * n


def balance(lengths: list[int], size: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """(document, start, length, sequence) of the pieces of documents with these numbers of tokens.

    Whole sequences are cut off long documents. What remains goes, by falling cost, to the sequence of lowest cost
    that has room for it; if none has, it is cut and fills the sequence with most room. The sequences have room for
    just the tokens there are: all are of ``size``, but for the last tokens, which get one sequence for each power of
    two in their number, so that no place is padded.
    """
    pieces, made, rest = [], 0, []
    for doc, n in enumerate(lengths):
        for start in range(0, n - size + 1, size):
            pieces.append((doc, start, size, made))
            made += 1
        if n % size:
            rest.append((n % size, doc, n - n % size))
    total = sum(r[0] for r in rest)
    room = [size] * (total // size) + [1 << b for b in reversed(range(size.bit_length())) if (total % size) >> b & 1]
    room = np.array(room, dtype=np.int64)
    spent = np.zeros(len(room))
    for n, doc, start in sorted(rest, key=lambda r: (-cost(r[0]), r[1])):
        while n:
            if (fits := room >= n).any():
                at, part = int(np.where(fits, spent, np.inf).argmin()), n
            else:
                at = int(room.argmax())
                part = int(room[at])
            pieces.append((doc, start, part, made + at))
            room[at] -= part
            spent[at] += cost(part)
            n, start = n - part, start + part
    return pieces


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset, cost.

    A document's ids are those of its text and END_ID. A task packs the documents of its partition in windows of about
    WINDOW_TOKENS tokens, so nothing is shuffled and no task holds more than a window and one text. Sequence numbers
    are the partition's number and a count; they are unique, not gapless.

    A null or empty text is the one id END_ID; a very long text is cut into whole sequences and a remainder; rows
    with a null or repeated doc_id are packed each for itself; ties of cost go to the earlier row; an empty table gives no
    rows; further columns are ignored.
    """
    path = path or public_tokenizers.path(FILE)

    def pack(window: list, part: int, done: int) -> tuple[pa.RecordBatch, int]:
        found = balance([len(ids) for _, ids in window], size)
        found.sort(key=lambda p: (p[3], -p[2], p[0]))
        offsets, at, last = [], 0, None
        for p in found:
            at = 0 if p[3] != last else at
            offsets.append(at)
            at, last = at + p[2], p[3]
        cols = [
            [window[d][0] for d, *_ in found], [p[1] for p in found], [p[2] for p in found],
            [window[d][1][s:s + n].tobytes() for d, s, n, _ in found], [len(window[p[0]][1]) for p in found],
            [(part << 40) + done + p[3] for p in found], offsets, [float(cost(p[2])) for p in found],
        ]
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.float64()]
        names = [c.split()[0] for c in PIECES.split(", ")]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
        return batch, done + 1 + max(p[3] for p in found)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path), TaskContext.get().partitionId()
        window, held, done = [], 0, 0
        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*encode(text or ""), END_ID], dtype="<u4")
                window.append((doc_id, ids))
                held += len(ids)
                if held >= WINDOW_TOKENS:
                    out, done = pack(window, part, done)
                    yield out
                    window, held = [], 0
        if window:
            yield pack(window, part, done)[0]

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(run, PIECES)
