"""Prefixes of token sets under the order by frequency, without a table of all tokens.

Tokens are uniform 64-bit hashes, a set per class of equal documents. Map tasks gather
documents in chunks of about ``BUFFER`` tokens and cut the tokens by their leading bits into
slices; a row holds those of one chunk and slice: 32 further bits of each, and the place of
its class in the chunk. Spark shuffles rows by slice. There a token's rows are counted, and
tokens that come once are left out; the others return to their chunk with the count. A chunk
then knows of each set how many tokens nobody shares, and the order of the others.

All work follows the number of tokens. Nothing is broadcast and nothing grows fuller: slices
become more as the input grows, and within one tokens are told apart by 32 bits. Tokens that
fall together there count as one token that is held more often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from hrforge.llm.common import U64, plan_bytes, power_of_two
from hrforge.llm.sketch import BUFFER, from_planes, packed_rows, planes

#: Bytes of input to a slice of the tokens.
SLICE = 4 << 20
#: Counts from which on tokens are equally frequent.
MOST = 127
#: Documents of a chunk: two bytes name one.
ROWS = 1 << 16
#: A document in the head of its chunk; ``owner``: the place of its class among the chunk's sets.
HEAD = np.dtype([("doc_id", "<i8"), ("null", "?"), ("class", "V16"), ("size", "<i4"),
                 ("owner", "<u2"), ("counting", "?"), ("bits", "<i8", (8,))])
PACKETS = "slice int, chunk long, owners binary, keys binary, counts binary, head binary"
_SCHEMA = pa.schema([("slice", pa.int32()), ("chunk", pa.int64()), *[(c, pa.binary()) for c in ("owners", "keys", "counts", "head")]])
_PACKETS = _SCHEMA.names
BITS = [f"bits{i}" for i in range(8)]
POSTING = "kind int, doc_id long, class binary, size int, token long, place int, alone int, " + ", ".join(f"{b} long" for b in BITS)
_NAMES = ["kind", "doc_id", "class", "size", "token", "place", "alone", *BITS]


def _packets(docs: DataFrame, sets_of: Callable, bits: int) -> DataFrame:
    """Rows of tokens by chunk and slice, and a row with the documents of each chunk."""

    def run(batches):
        task = TaskContext.get().partitionId()
        heads, sets, places, size, chunks = [], [], {}, 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            head = np.empty(len(heads), HEAD)
            for name, values in zip(HEAD.names, zip(*heads)):
                head[name] = np.frombuffer(b"".join(values), "V16") if name == "class" else np.array(values)
            head = head.tobytes()
            own = task.to_bytes(8, "little") + chunks.to_bytes(8, "little")
            chunk = int.from_bytes(hashlib.blake2b(head, digest_size=8, salt=own).digest(), "little", signed=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk & ((1 << bits) - 1)], pa.int32()), pa.array([chunk], pa.int64()), *[pa.nulls(1, pa.binary())] * 3,
                 pa.array([head], pa.binary())], _PACKETS)
            tokens = np.concatenate(sets or [np.empty(0, U64)])
            owners = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(t) for t in sets])
            keys = (tokens >> U64(32 - bits)).astype(np.uint32)
            got = packed_rows(["slice", "owners", "keys"], (tokens >> U64(64 - bits)).astype(np.uint16), [owners, keys], planes)
            if got is not None:
                n = got.num_rows
                yield pa.RecordBatch.from_arrays(
                    [got.column(0), pa.array(np.full(n, chunk)), got.column(1), got.column(2), *[pa.nulls(n, pa.binary())] * 2], _PACKETS)

        for batch in batches:
            for doc_id, (name, n, marks, tokens) in zip(batch.column(0).to_pylist(), sets_of(batch)):
                if tokens is None:
                    owner = 0
                elif name in places:
                    owner = places[name]
                else:
                    owner = places[name] = len(sets)
                    sets.append(tokens)
                    size += len(tokens)
                heads.append((doc_id or 0, doc_id is None, name, n, owner, tokens is not None, marks))
                if size >= BUFFER or len(heads) >= ROWS:
                    yield from flush()
                    heads, sets, places, size, chunks = [], [], {}, 0, chunks + 1
        if heads:
            yield from flush()

    return docs.mapInArrow(run, PACKETS)


def _counted(packets: DataFrame) -> DataFrame:
    """The tokens of a slice that several rows hold, with their counts; heads pass."""

    def run(group: pa.Table) -> pa.Table:
        heads = group.filter(pc.is_valid(group["head"]))
        rows = group.filter(pc.is_null(group["head"]))
        owners, keys = from_planes(rows["owners"], np.uint16), from_planes(rows["keys"], np.uint32)
        ends = np.cumsum(pc.binary_length(rows["keys"]).to_numpy().astype(np.int64) // 4)
        order = np.sort((keys.astype(U64) << U64(32)) | np.arange(len(keys), dtype=U64))
        value = (order >> U64(32)).astype(np.uint32)
        begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])[:len(value)])
        times = np.diff(begin, append=len(value))
        count = np.empty(len(keys), np.uint8)
        count[(order & U64(0xFFFFFFFF)).astype(np.int64)] = np.repeat(np.minimum(times, MOST), times)
        often = np.flatnonzero(count > 1)
        cuts = np.searchsorted(often, ends)
        cols = [[] for _ in _PACKETS]
        for chunk, a, b in zip(rows["chunk"].to_pylist(), np.concatenate([[0], cuts]).tolist(), cuts.tolist()):
            if a < b:
                at = often[a:b]
                for c, x in zip(cols, (group["slice"][0].as_py(), chunk, planes(owners[at]), planes(keys[at]), count[at].tobytes(), None)):
                    c.append(x)
        got = pa.table([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA)], _SCHEMA)
        return pa.concat_tables([got, heads.select(_PACKETS).cast(_SCHEMA)])

    return packets.groupBy("slice").applyInArrow(run, PACKETS)


def prefixes(docs: DataFrame, sets_of: Callable, prefix_size: Callable) -> DataFrame:
    """One row per document (kind 0), and one per prefix token that several sets hold (kind 1;
    once for the equal documents of a chunk). ``docs`` has doc_id first. ``sets_of`` makes of
    each row of a batch: its class, the size of its set, 512 bits of marks as eight numbers, and
    the sorted tokens, or None where the set counts elsewhere.

    In the order tokens that come once precede the others (``alone``: how many), which ascend
    by count and then by value; so do the numbers given as ``token``."""

    def run(group: pa.Table) -> pa.Table:
        head = group["head"].drop_null()
        if len(head) != 1:
            raise RuntimeError(f"{len(head)} heads of a chunk: the rows of a task changed when it ran again")
        rows = group.filter(pc.is_null(group["head"]))
        d = np.frombuffer(head[0].as_buffer(), HEAD)
        names = pa.Array.from_buffers(pa.binary(16), len(d), [None, pa.py_buffer(d["class"].tobytes())]).cast(pa.binary())
        documents = [pa.array(np.zeros(len(d), np.int32)), pa.array(d["doc_id"], mask=d["null"]), names, pa.array(d["size"].copy()),
                     pa.nulls(len(d), pa.int64()), *[pa.nulls(len(d), pa.int32())] * 2,
                     *[pa.array(np.ascontiguousarray(x)) for x in d["bits"].T]]

        owners, keys = from_planes(rows["owners"], np.uint16), from_planes(rows["keys"], np.uint32)
        counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint8)
        slice_ = np.repeat(rows["slice"].to_numpy(), pc.binary_length(rows["counts"]).to_numpy())
        token = (counts.astype(np.int64) << 56) | (slice_.astype(np.int64) << 32) | keys
        order = np.lexsort((token, owners))
        owners, token = owners[order], token[order]
        first = np.zeros(ROWS, np.int64)  # a document of each set
        counting = d["counting"]
        first[d["owner"][counting][::-1]] = np.flatnonzero(counting)[::-1]
        several = np.bincount(owners, minlength=ROWS)
        alone = d["size"][first] - several
        place = alone[owners] + np.arange(len(owners)) - (np.cumsum(several) - several)[owners]
        kept = place < prefix_size(d["size"][first].astype(np.int64))[owners]
        of, n = first[owners[kept]], int(kept.sum())
        tokens = [pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), names.take(pa.array(of)), pa.array(d["size"][of]),
                  pa.array(token[kept]), pa.array(place[kept].astype(np.int32)), pa.array(alone[owners[kept]].astype(np.int32)),
                  *[pa.nulls(n, pa.int64())] * 8]
        return pa.concat_tables([pa.table(documents, _NAMES), pa.table(tokens, _NAMES)])

    return _counted(_packets(docs, sets_of, power_of_two(plan_bytes(docs) / SLICE, 5, 16))).groupBy("chunk").applyInArrow(run, POSTING)
