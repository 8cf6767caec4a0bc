"""Byte-level BPE encoding and decoding through a global shuffle of distinct pre-tokens.

A text is cut into pre-tokens by the tokenizer's pattern; each pre-token is encoded for itself by the
rank file (lowest rank first, leftmost of equal ranks).

1. Documents are dealt into chunks of about `chunk_bytes` of text by a hash of their row, packed and
   shuffled once; both later steps read that one exchange.
2. Explode: every chunk gives its distinct pre-tokens, (chunk, word). They are shuffled by word and sorted,
   so that all chunks' rows of a word meet, and each distinct word is encoded once in the whole job.
3. Join back: words and ids return to their chunk (a task sends those of one chunk together), where the documents' pre-tokens, in their positions,
   are replaced by ids.

A word is at most one row a chunk, however often it occurs, so no key grows beyond the number of chunks.
Decoding looks ids up in the token-byte table (the fixed vocabulary, broadcast).

Cases: null and empty texts have no tokens; equal rows are packed as one row with their number and come
back as many times; null keys are keys; an empty table gives an empty result; only the two named columns
are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import heapq
import io
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import spans

#: Letters of the pattern's contractions: 's 't 'm 'd, and 're 've 'll (fixed values).
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")
CHUNK_BYTES = 24 << 20
COMPRESSION_LEVEL = 5
#: Characters split at a time inside a task.
BLOCK_CHARS = 1 << 20
#: Bytes up to which a pre-token's pairs are searched one by one.
LONG_PIECE = 64
#: Encoded words that a task gathers by chunk before it sends them on.
HELD_WORDS = 200_000
#: Ends a text inside a block: a lone surrogate, which no valid text holds.
END = "\ud800"
END_BYTES = END.encode("utf-8", "surrogatepass")
LETTER, NUMBER, OTHER, SPACE, STOP = range(5)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank (id) of a rank file: base64 token and number a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point, by the Unicode properties that the pattern names."""
    import regex

    found = np.full(0x110000, OTHER, np.uint8)
    points = np.setdiff1d(np.arange(0x110000, dtype=np.uint32), np.arange(0xD800, 0xE000, dtype=np.uint32))
    every = points.astype("<u4").tobytes().decode("utf-32-le")
    for cls, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\p{White_Space}")):
        hits = "".join(regex.findall(pattern, every))
        found[np.frombuffer(hits.encode("utf-32-le"), "<u4")] = cls
    found[ord(END)] = STOP
    return found


def split_block(block: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens of a block of texts, each text ended by `END` (which is a pre-token of its own).

    The block's UTF-8 bytes, padded; the first byte of every pre-token and the end of the last one; and
    which pre-tokens are ends of texts. Runs of one class are pre-tokens; a blank before a letter, number
    or other run belongs to it; other white space keeps its last character apart where something follows;
    an apostrophe that starts a pre-token takes the letters of a contraction.
    """
    points = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4")
    cls = _classes()[points]
    start = np.empty(len(cls), bool)
    start[:1] = True
    np.not_equal(cls[1:], cls[:-1], out=start[1:])
    start |= cls == STOP
    # The last white space before something else starts a pre-token; a blank there takes the run that follows.
    last = np.zeros(len(cls), bool)
    space = cls == SPACE
    last[:-1] = space[:-1] & ~space[1:] & (cls[1:] != STOP)
    start |= last
    start[np.flatnonzero(last & (points == 0x20)) + 1] = False
    # Contractions: a single apostrophe that starts a pre-token, before the letters of an ending.
    quotes = np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (cls[1:] == LETTER))
    for at in quotes.tolist():
        tail = block[at + 1:at + 3]
        size = 1 if tail[0] in SHORT_ENDINGS else 2 if tail in LONG_ENDINGS else 0
        if size:
            start[at + 1] = False
            start[at + 1 + size] = True
    firsts = np.flatnonzero(start)
    place = np.zeros(len(points) + 1, np.int64)  # first byte of every code point
    width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    np.cumsum(width, out=place[1:])
    data = spans.pad(np.frombuffer(block.encode("utf-8", "surrogatepass"), np.uint8))
    return data, place[np.append(firsts, len(points))], cls[firsts] == STOP


def blocks_of(texts: list[str]) -> Iterator[tuple[int, str]]:
    """(first row, block): whole texts joined to blocks of about `BLOCK_CHARS`, each ended by `END`."""
    begin, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= BLOCK_CHARS or i + 1 == len(texts):
            yield begin, END.join(texts[begin:i + 1]) + END
            begin, size = i + 1, 0


def distinct_words(block: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The block's distinct pre-tokens, the number of each pre-token among them, and which end a text."""
    data, edges, stops = split_block(block)
    starts, sizes = edges[:-1], np.diff(edges)
    owner = spans.insert_spans(data, starts, sizes)
    own = owner == np.arange(len(owner))
    number = np.cumsum(own) - 1
    raw = data.tobytes()
    words = [raw[a:a + n] for a, n in zip(starts[own].tolist(), sizes[own].tolist())]
    return words, number[owner], stops


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank, the leftmost of equal ones, is joined until
    no pair has a rank. Long pieces find that pair by a heap, so their time is not quadratic."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > LONG_PIECE:
        return _merge_long(piece, ranks)
    none = 1 << 62
    edges = list(range(len(piece) + 1))
    pairs = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (lowest := min(pairs)) != none:
        i = pairs.index(lowest)
        del edges[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(piece[edges[i]:edges[i + 2]], none)
        if i:
            pairs[i - 1] = ranks.get(piece[edges[i - 1]:edges[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(edges, edges[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    parts: list[bytes] = [piece[i:i + 1] for i in range(len(piece))]
    after = list(range(1, len(parts) + 1))
    before = list(range(-1, len(parts) - 1))
    heap = [(rank, i) for i in range(len(parts) - 1)
            if (rank := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= len(parts) or ranks.get(parts[i] + parts[j]) != rank:
            continue  # joined meanwhile: this pair is no longer there
        parts[i] += parts[j]
        parts[j] = b""
        k = after[i] = after[j]
        if k < len(parts):
            before[k] = i
            if (rank := ranks.get(parts[i] + parts[k])) is not None:
                heapq.heappush(heap, (rank, i))
        h = before[i]
        if h >= 0 and (rank := ranks.get(parts[h] + parts[i])) is not None:
            heapq.heappush(heap, (rank, h))
    return [ranks[part] for part in parts if part]


def _packed(rows: list[tuple], schema: pa.Schema) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(
            compression=pa.Codec("zstd", compression_level=COMPRESSION_LEVEL))) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema))
    return sink.getvalue()


def _joined(dealt: dict[int, list[tuple[bytes, bytes]]]) -> pa.RecordBatch:
    """One row a chunk: the sizes of its words and of their ids, and both joined."""
    columns = [[np.array([(len(w), len(i)) for w, i in pairs], "<u4").tobytes() for pairs in dealt.values()],
               [b"".join(w for w, _ in pairs) for pairs in dealt.values()],
               [b"".join(i for _, i in pairs) for pairs in dealt.values()]]
    return pa.RecordBatch.from_arrays([pa.array(list(dealt), pa.int32())] + [pa.array(c, pa.binary()) for c in columns],
                                      ["chunk", "sizes", "words", "ids"])


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


class TokenBytes:
    """The token-byte table: bytes of all tokens in a row, with the place and size of each."""

    def __init__(self, ranks: dict[bytes, int]):
        self.sizes = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.values = np.zeros(int(self.sizes.sum()), np.uint8)
        for token, rank in ranks.items():
            self.values[self.starts[rank]:self.starts[rank] + len(token)] = np.frombuffer(token, np.uint8)

    def join(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Bytes of the ids up to each end, as a binary column; an id outside the table raises ValueError."""
        if len(ids) and ids.max() >= len(self.sizes):
            raise ValueError(f"id {ids.max()} is outside the vocabulary")
        after = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[ids], out=after[1:])
        return spans.binary_array(spans.take_spans(self.values, self.starts[ids], self.sizes[ids]), after[ends])


def encode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text",
           chunk_bytes: int = CHUNK_BYTES, decoded: bool = False) -> DataFrame:
    """`key`, n_tokens (long) and ids (binary: little-endian unsigned 32-bit) of every row's whole text;
    with `decoded` also the bytes of those ids, looked up where the ids are put together."""
    source = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    key_type = source.schema["key"].dataType.simpleString()
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = total // chunk_bytes + 1
    # The vocabulary file, which does not grow with the data.
    shared = df.sparkSession.sparkContext.broadcast((ranks, TokenBytes(ranks)))
    id_type = "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"  # on the way back to the chunks

    names = ["key", "n_tokens", "ids", "decoded"][:3 + decoded]
    schema = f"key {key_type}, n_tokens long, ids binary" + ", decoded binary" * decoded

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("key", batch.schema.field("key").type), ("text", pa.large_string()),
                                ("copies", pa.int64())])
            rows = Counter(zip(*(batch.column(i).to_pylist() for i in range(3))))
            dealt = defaultdict(list)
            for (chunk, k, t), copies in rows.items():
                dealt[chunk].append((k, t, copies))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(dealt), pa.int32()),
                 pa.array([_packed(part, schema) for part in dealt.values()], pa.binary())], ["chunk", "packed"])

    def explode_words(chunk: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[bytes] = set()
        for batch in batches:
            for blob in batch.column("packed"):
                for _, block in blocks_of(_unpacked(blob.as_py()).column("text").to_pylist()):
                    words.update(distinct_words(block)[0])
        words.discard(END_BYTES)
        found = list(words)
        for i in range(0, len(found), 50_000):
            part = found[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk[0].as_py()] * len(part), pa.int32()), pa.array(part, pa.binary())], ["chunk", "word"])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (ranks, _), last, ids = shared.value, None, b""
        dealt, held = defaultdict(list), 0
        for batch in batches:  # sorted by word: a word's rows follow each other, across batches too
            for chunk, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if word != last:
                    last, ids = word, np.array(merge_bytes(word, ranks), id_type).tobytes()
                dealt[chunk].append((word, ids))
            held += batch.num_rows
            if held >= HELD_WORDS:
                yield _joined(dealt)
                dealt, held = defaultdict(list), 0
        if dealt:
            yield _joined(dealt)

    def reassemble(chunk: tuple, packed: pa.Table, words: pa.Table) -> pa.Table:
        ids_of = {END_BYTES: b""}
        for row in words.select(["sizes", "words", "ids"]).to_pylist():
            ends = np.cumsum(np.frombuffer(row["sizes"], "<u4").reshape(-1, 2), axis=0, dtype=np.int64)
            begin = [0, 0]
            for end in ends.tolist():
                ids_of[row["words"][begin[0]:end[0]]] = row["ids"][begin[1]:end[1]]
                begin = end
        out = []
        for blob in packed.column("packed"):
            rows = _unpacked(blob.as_py())
            for row, block in blocks_of(rows.column("text").to_pylist()):
                words_here, number, stops = distinct_words(block)
                coded = [ids_of[word] for word in words_here]
                n_ids = np.array([len(ids) for ids in coded]) // np.dtype(id_type).itemsize
                ids = spans.take_spans(np.frombuffer(b"".join(coded), id_type), (np.cumsum(n_ids) - n_ids)[number],
                                       n_ids[number]).astype("<u4")
                ends = np.cumsum(n_ids[number])[stops]
                here = rows.slice(row, len(ends))
                columns = [here.column("key").combine_chunks(), pa.array(np.diff(ends, prepend=0), pa.int64()),
                           spans.binary_array(ids, ends)]
                if decoded:
                    columns.append(shared.value[1].join(ids, ends))
                copies = here.column("copies").to_numpy()
                out.append(pa.RecordBatch.from_arrays(columns, names).take(
                    pa.array(np.repeat(np.arange(len(ends)), copies))))
        return pa.Table.from_batches(out, out[0].schema)

    chunk = F.pmod(F.xxhash64("key", "text"), F.lit(n_chunks)).cast("int").alias("chunk")
    chunks = (source.select(chunk, "key", "text").mapInArrow(pack, "chunk int, packed binary")
              .repartition(n_chunks, "chunk"))
    words = (chunks.groupBy("chunk").applyInArrow(explode_words, "chunk int, word binary")
             .repartition("word").sortWithinPartitions("word")
             .mapInArrow(encode_words, "chunk int, sizes binary, words binary, ids binary"))
    encoded = chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(reassemble, schema)
    return encoded.withColumnRenamed("key", key)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """`df` with `out`: the bytes of the tokens in `ids`, in order (null ids: null).

    The token-byte table is the vocabulary turned round; an id outside it raises ValueError.
    """
    shared = df.sparkSession.sparkContext.broadcast(TokenBytes(ranks))
    kept = [i for i, name in enumerate(df.columns) if name != out]
    names = [df.columns[i] for i in kept] + [out]
    at = df.columns.index(ids)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out]
                       + [f"`{out}` binary"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.large_binary())
            numbers = [np.frombuffer(value.as_buffer(), "<u4") if value.is_valid else None for value in column]
            given = [n for n in numbers if n is not None]
            found = shared.value.join(np.concatenate(given or [np.empty(0, "<u4")]),
                                      np.cumsum([len(n) for n in given], dtype=np.int64))
            place = iter(range(len(given)))
            rows = pa.array([None if n is None else next(place) for n in numbers], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in kept] + [found.take(rows)], names)

    return df.mapInArrow(look_up, schema)
