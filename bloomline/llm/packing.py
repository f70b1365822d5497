"""Cost-balanced packing of token sequences.

The cost of a piece of n tokens is ``linear * n + quadratic * n * n`` (attention stays inside a piece). Parts of a
document that fill a sequence alone are cut off first; the rest are dealt in descending order, each to the cheapest
sequence with room for it, or cut where no sequence has room. Only as many sequences are opened as the tokens fill
exactly; what is left over waits for the next documents. At the end of a partition the last tokens, fewer than one
sequence, are laid out in sequences whose lengths are powers of two. So there is no padding.

Packing runs where the documents lie: no shuffle, bounded memory (one group of sequences), and the same result if a lost
task runs again. sequence_id is the partition's number and a counter within it.

Defined results: null or empty text is just the closing id; repeated rows are packed each; an empty table gives none;
other columns of the input aren't carried.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomline.llm.bpe import encoder

#: Sequences that are balanced against each other.
GROUP_SEQUENCES = 128
#: Pieces of a batch that goes back to Spark.
FLUSH_PIECES = 512
FIELDS = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def balance(lengths: list[int], room: int, linear: float, quadratic: float) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Fills ``sum(lengths) // room`` sequences exactly. Pieces are (item, start within it, length): those of each
    sequence, in order, and those left over (fewer tokens than room)."""
    count = sum(lengths) // room
    pieces = [(-n, k, 0) for k, n in enumerate(lengths)]
    heapq.heapify(pieces)
    filled: list[list[tuple[int, int, int]]] = [[] for _ in range(count)]
    open_: list[tuple[float, int]] = [(0.0, s) for s in range(count)]
    left = [room] * count
    while pieces and open_:
        n, k, start = heapq.heappop(pieces)
        n, passed, chosen = -n, [], None
        while open_:
            cost, s = heapq.heappop(open_)
            if left[s] >= n:
                chosen = cost, s
                break
            passed.append((cost, s))
        if chosen is None:  # none has room for all of it: the cheapest takes what it has room for
            chosen, passed = passed[0], passed[1:]
        cost, s = chosen
        for p in passed:
            heapq.heappush(open_, p)
        put = min(n, left[s])
        filled[s].append((k, start, put))
        left[s] -= put
        if left[s]:
            heapq.heappush(open_, (cost + linear * put + quadratic * put * put, s))
        if n > put:
            heapq.heappush(pieces, (put - n, k, start + put))
    return filled, [(k, start, -n) for n, k, start in sorted(pieces)]


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048,
    close_id: int = 1, linear: float = 1.0, quadratic: float = 1 / 1024,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset."""
    closing = close_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, count = TaskContext.get().partitionId() << 32, 0
        out: list[tuple] = []
        waiting: list[tuple] = []  # doc_id, ids, place of these ids in the document, doc_tokens
        held = 0

        def put(pieces: list[tuple]) -> None:
            nonlocal count
            offset = 0
            for doc, ids, start, n, total in pieces:
                out.append((doc, start, n, ids, total, base + count, offset))
                offset += n
            count += 1

        def settle(last: bool) -> None:
            nonlocal waiting, held
            filled, rest = balance([len(w[1]) // 4 for w in waiting], capacity, linear, quadratic)
            cut = lambda k, at, n: (waiting[k][0], waiting[k][1][4 * at : 4 * (at + n)], waiting[k][2] + at, n, waiting[k][3])
            for pieces in filled:
                put([cut(*p) for p in pieces])
            left = [cut(*p) for p in rest]
            waiting = [(doc, ids, start, total) for doc, ids, start, _, total in left]
            held = sum(n for *_, n, _ in left)
            if last:
                queue = left[::-1]
                while held:
                    room = 1 << (held.bit_length() - 1)
                    held -= room
                    row = []
                    while room:
                        doc, ids, start, n, total = queue.pop()
                        use = min(n, room)
                        row.append((doc, ids[: 4 * use], start, use, total))
                        if n > use:
                            queue.append((doc, ids[4 * use :], start + use, n - use, total))
                        room -= use
                    put(row)

        def flush() -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out, strict=True)) or [()] * len(FIELDS)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], FIELDS)

        bpe, id_type = encoder(tokenizer_path, speculate=False), None
        for batch in batches:
            id_type = batch.column("id").type
            encoded = bpe.encode(batch.column("text").to_pylist())
            for doc, ids in zip(batch.column("id").to_pylist(), encoded, strict=True):
                ids += closing
                total = len(ids) // 4
                whole = total // capacity * capacity
                for start in range(0, whole, capacity):
                    put([(doc, ids[4 * start : 4 * (start + capacity)], start, capacity, total)])
                if total > whole:
                    waiting.append((doc, ids[4 * whole :], whole, total))
                    held += total - whole
                if held >= GROUP_SEQUENCES * capacity:
                    settle(False)
                if len(out) >= FLUSH_PIECES:
                    yield flush()
        if id_type is not None:
            settle(True)
            yield flush()

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint",
    )
