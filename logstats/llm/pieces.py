"""SentencePiece encoding and decoding through a table of distinct chunks.

A text is cut in chunks: before each run of white-space markers that follows something else,
and before each line feed. No piece of the model spans such a place (``Model.of`` tests it on
the whole vocabulary), so what a chunk is segmented into does not depend on its neighbours,
and the ids of a text are the ids of its chunks one after the other.

1. The chunks of all texts are counted; map-side counts go into the shuffle.
2. Each distinct chunk is segmented, and its ids decoded, once by the library. That gives the
   chunk table.
3. Ids are joined back. The ``HEAD_CHUNKS`` most frequent chunks, a fixed number with a fixed
   longest length, go to every task. What they do not cover is asked for as pairs of text
   and chunk, joined to the table by shuffle, and sent to the text, which travels packed.

A chunk that is in very many texts is one of the most frequent ones, so neither shuffle has
a hot key. Answers are put together by a 64-bit digest of the text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.llm.common import read_table, shuffles_removed, unused
from logstats.scratch import checkpointed

MARKER = "▁"
# The part of the chunk table that every task gets: so many chunks of at most so many bytes.
HEAD_CHUNKS = 1 << 20
HEAD_BYTES = 48
# Texts are cut in chunks together up to so many bytes.
PART_BYTES = 8 << 20

_SPACE, _LINE = 0x20, 0x0A


@dataclass
class Model:
    """A sentencepiece model by its path, loaded once in each process that uses it."""

    path: str
    cut_lines: bool = True
    _loaded: object = field(default=None, repr=False)

    @classmethod
    def of(cls, path: str) -> Model:
        """The model, after a test that its pieces cannot cross the places of the cuts."""
        model = cls(path)
        library = model.library
        for id_ in range(library.get_piece_size()):
            piece = library.id_to_piece(id_)
            if MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {id_} crosses a white-space marker")
            if "\n" in piece:
                model.cut_lines = False
        kept = library.encode("a  Ａ", out_type=str)
        if "".join(kept) != f"{MARKER}a{MARKER * 2}Ａ" and not any(p.startswith("<0x") for p in kept):
            raise ValueError("the model changes texts before it segments them")
        return model

    def __getstate__(self) -> dict:
        return {"path": self.path, "cut_lines": self.cut_lines, "_loaded": None}

    @property
    def library(self):
        if self._loaded is None:
            import sentencepiece

            self._loaded = sentencepiece.SentencePieceProcessor(model_file=self.path)
        return self._loaded

    @property
    def id_type(self) -> type:
        return np.uint32 if self.library.get_piece_size() > 1 << 16 else np.uint16

    @property
    def end_id(self) -> int:
        return self.library.eos_id()

    def segment(self, chunk: str) -> list[int]:
        """Ids of a chunk. The library puts a marker before what it gets.

        A chunk that starts with a line feed drops it; any other one starts with a marker,
        which is left out. A line feed at the end keeps a lone marker from being an empty text.
        """
        encode = self.library.encode
        if not self.cut_lines:
            return encode(chunk[1:]) if len(chunk) > 1 else [self.library.piece_to_id(MARKER)]
        line = len(encode("\n\n")) - len(encode("\n"))
        if chunk.startswith("\n"):
            return encode(chunk)[len(encode("\n")) - line :]
        ids = encode(chunk[1:] + "\n")
        return ids[: len(ids) - line]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def marked(text: str | None) -> bytes:
    """A text as it is segmented, with blanks for markers; nothing for an empty one."""
    if not text:
        return b""
    return b" " + text.replace(MARKER, " ").encode("utf-8", "surrogatepass")


def cut_chunks(texts: list[bytes], cut_lines: bool = True) -> tuple[pa.Array, np.ndarray]:
    """All chunks of marked texts, and the number of them in each text."""
    data = b"".join(texts)
    ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
    if not data:
        return pa.array([], pa.large_string()), np.zeros(len(texts), dtype=np.int64)
    codes = np.frombuffer(data, dtype=np.uint8)
    space = codes == _SPACE
    starts = space.copy()
    starts[1:] &= ~space[:-1]
    if cut_lines:
        starts |= codes == _LINE
    begins = ends[:-1]
    starts[begins[begins < len(codes)]] = True
    offsets = np.append(np.flatnonzero(starts), len(codes)).astype(np.int64)
    chunks = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
    per_text = np.diff(np.searchsorted(offsets, ends, side="left"), prepend=0)
    return chunks, per_text


def _parts(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``PART_BYTES`` together; one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > PART_BYTES:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def chunk_counts(docs: DataFrame, model: Model) -> DataFrame:
    """``chunk`` and ``n``, how often it occurs in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [marked(text) for text in batch.column(0).to_pylist()]
            for start, end in _parts(texts):
                chunks, _ = cut_chunks(texts[start:end], model.cut_lines)
                values, counts = pc.value_counts(chunks).flatten()
                yield pa.RecordBatch.from_arrays([values.cast(pa.string()), counts], ["chunk", "n"])

    counted = docs.select("text").mapInArrow(count, "chunk string, n long")
    return counted.groupBy("chunk").agg(F.sum("n").alias("n"))


def _ipc(batch: pa.RecordBatch) -> bytes:
    """A batch in Arrow's stream format, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def chunk_table(docs: DataFrame, model: Model) -> DataFrame:
    """``chunk``, ``n``, its ``ids``, two bytes each or four, and whether they decode to it
    (``exact``); each chunk is segmented and decoded once.

    The rows are checkpointed as compressed batches, which are a quarter of their size.
    """
    kind = model.id_type

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column("chunk").to_pylist()
            listed = [model.segment(chunk) for chunk in chunks]
            ids = pa.array([np.array(one, dtype=kind).tobytes() for one in listed], pa.binary())
            exact = pa.array([model.decode(one) == chunk.removeprefix(" ") for one, chunk in zip(listed, chunks, strict=True)])
            found = [batch.column("chunk"), batch.column("n"), ids, exact]
            batch = pa.RecordBatch.from_arrays(found, ["chunk", "n", "ids", "exact"])
            yield pa.RecordBatch.from_arrays([pa.array([_ipc(batch)], pa.binary())], ["batch"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("batch").to_pylist():
                yield from pa.ipc.open_stream(packed)

    packed = checkpointed(chunk_counts(docs, model).mapInArrow(segment, "batch binary"))
    return packed.mapInArrow(read, "chunk string, n long, ids binary, exact boolean")


@dataclass
class Head:
    """Frequent chunks and their ids, in arrays that a batch of chunks is looked up in."""

    chunks: pa.Array
    ids: np.ndarray
    edges: np.ndarray
    # How often a chunk of at most ``HEAD_BYTES`` occurs to be here.
    least: int

    def __getstate__(self) -> tuple:
        """Packed, for it is sent to every executor and lies on its disk."""
        lengths = np.diff(self.edges)
        arrays = (self.chunks.cast(pa.string()), pa.array(self.ids), pa.array(lengths))
        return [_ipc(pa.RecordBatch.from_arrays([array], ["values"])) for array in arrays], self.least

    def __setstate__(self, state: tuple) -> None:
        packed, self.least = state
        chunks, ids, lengths = (pa.ipc.open_stream(one).read_next_batch().column(0) for one in packed)
        self.chunks, self.ids = chunks.cast(pa.large_string()), ids.to_numpy()
        self.edges = np.cumsum(np.concatenate([[0], lengths.to_numpy()]), dtype=np.int64)

    @classmethod
    def of(cls, table: DataFrame, kind: type, most: int) -> Head:
        """At most ``most`` rows of at most ``HEAD_BYTES`` each come to the driver."""
        short = table.filter(F.octet_length("chunk") <= HEAD_BYTES)
        least = _frequency_of_place(short, most)
        rows = short.filter(F.col("n") >= least).select("chunk", "ids").toArrow()
        chunks = rows.column("chunk").cast(pa.large_string()).combine_chunks()
        ids = rows.column("ids").to_pylist()
        lengths = [len(data) // np.dtype(kind).itemsize for data in ids]
        return cls(chunks, np.frombuffer(b"".join(ids), dtype=kind), np.cumsum([0, *lengths], dtype=np.int64), least)

    def places(self, chunks: pa.Array) -> np.ndarray:
        """The place of each chunk, -1 where it is not there."""
        if len(self.chunks) == 0:
            return np.full(len(chunks), -1, dtype=np.int64)
        return pc.fill_null(pc.index_in(chunks, value_set=self.chunks), -1).to_numpy().astype(np.int64)

    def with_more(self, places: np.ndarray, lost: list[str], more: dict[str, bytes]) -> tuple[Head, np.ndarray]:
        """The head with ids of more chunks, and places with those of the lost ones filled in."""
        extra = {chunk: len(self.edges) - 1 + i for i, chunk in enumerate(more)}
        ids = [np.frombuffer(data, dtype=self.ids.dtype) for data in more.values()]
        edges = self.edges[-1] + np.cumsum([len(one) for one in ids], dtype=np.int64)
        places = places.copy()
        places[places < 0] = [extra[chunk] for chunk in lost]
        more_ids, more_edges = np.concatenate([self.ids, *ids]), np.concatenate([self.edges, edges])
        return Head(self.chunks, more_ids, more_edges, self.least), places

    def ids_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all places one after the other, and how many each has."""
        starts = self.edges[places]
        lengths = self.edges[places + 1] - starts
        before = np.cumsum(lengths) - lengths
        at = np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - before, lengths)
        return self.ids[at], lengths


def _frequency_of_place(table: DataFrame, most: int) -> int:
    """The least n so that at most ``most`` rows have that or more."""
    doubling = table.groupBy((F.length(F.bin("n")) - 1).alias("power")).agg(F.count(F.lit(1)).alias("rows"))
    held, least = 0, 1
    for row in sorted(doubling.collect(), key=lambda r: -r["power"]):
        if held + row["rows"] > most:
            least = _split(table, int(row["power"]), most - held)
            break
        held += row["rows"]
    return least


def _split(table: DataFrame, power: int, room: int) -> int:
    """Within n from 2^power on, the least n that leaves at most ``room`` rows; by steps of a
    thousandth of that range, so that the answer has a bounded number of rows."""
    low, high = 1 << power, 2 << power
    step = max(1, (high - low) // 1000)
    some = table.filter(F.col("n").between(low, high - 1))
    cut = some.groupBy(F.expr(f"(n - {low}) div {step}").alias("at")).agg(F.count(F.lit(1)).alias("rows"))
    least = high
    for row in sorted(cut.collect(), key=lambda r: -r["at"]):
        room -= row["rows"]
        if room < 0:
            break
        least = low + row["at"] * step
    return least


def _digest(text: bytes) -> int:
    """A number for a text. Texts that share one are answered together, which does no harm:
    answers are looked up by their chunk."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little", signed=True)


@dataclass
class Rendering:
    """What is returned of the ids of a text.

    Where every chunk's ids decode to the chunk (``exact``), those of a text decode to its
    chunks; otherwise the library decodes the ids of each text.
    """

    model: Model
    exact: bool
    _names: list[str] = field(default_factory=list, repr=False)

    def __getstate__(self) -> dict:
        return {"model": self.model, "exact": self.exact, "_names": []}

    def of(self, text: bytes, ids: np.ndarray) -> tuple[int, bytes, bytes]:
        """Number of ids with the end id, the ids as text, the decoded text in UTF-8."""
        if not self._names:
            self._names.extend(map(str, range(self.model.library.get_piece_size())))
        names, listed = self._names, [*ids.tolist(), self.model.end_id]
        written = " ".join([names[i] for i in listed]).encode()
        if self.exact:
            return len(listed), written, text[1:]
        return len(listed), written, self.model.decode(listed).encode("utf-8", "surrogatepass")


_RESULT = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]


def _with_columns(batch: pa.RecordBatch, without: list[str], rows: list[tuple], more: list) -> pa.RecordBatch:
    """A batch without some columns and with more, given as rows."""
    kept = [name for name in batch.schema.names if name not in without]
    columns = zip(*rows, strict=True) if rows else [()] * len(more)
    added = [pa.array(values, kind) for values, (_, kind) in zip(columns, more, strict=True)]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(name) for name in kept), *added], [*kept, *(name for name, _ in more)]
    )


def _finished(rendering: Rendering, text: bytes, ids: np.ndarray) -> tuple[int, str, str]:
    n, written, decoded = rendering.of(text, ids)
    return n, hashlib.sha256(written).hexdigest(), hashlib.sha256(decoded).hexdigest()


def encode_documents(docs: DataFrame, model_path: str, head_chunks: int = HEAD_CHUNKS) -> DataFrame:
    """Every row of ``docs`` with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    The ids are those of the library with its end id and without a start id; the text is
    encoded whole. A null text is an empty one, whose only id is the end id. Equal texts have
    equal ids; a row that repeats is encoded like any other. Columns of these three names
    are replaced. An empty table gives an empty table.
    """
    model = Model.of(model_path)
    kind = model.id_type
    spark = docs.sparkSession
    with shuffles_removed(spark):
        table = chunk_table(docs, model)
        exact = table.agg(F.bool_and("exact")).head()[0] is not False
        head = spark.sparkContext.broadcast(Head.of(table, kind, head_chunks))
        resolved = checkpointed(_resolved(docs, table, model, head))
    rendering = Rendering(model, exact)
    docs = docs.drop("n_tokens", "ids_sha256", "decoded_sha256")
    key, packed, answers = (unused(name, docs) for name in ("_key", "_packed", "_answers"))

    def ids_of_texts(places: np.ndarray, per_text: np.ndarray, known: Head) -> list[np.ndarray]:
        """The ids of each text; chunks without a place have none."""
        ids, lengths = known.ids_at(places[places >= 0])
        per_chunk = np.zeros(len(places) + 1, dtype=np.int64)
        per_chunk[1:][places >= 0] = lengths
        ends = np.cumsum(per_chunk)[np.cumsum(per_text)]
        return np.split(ids, ends[:-1]) if len(ends) else []

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finish what the head covers; pack the texts of the others."""
        for batch in batches:
            texts = [marked(text) for text in batch.column("text").to_pylist()]
            out = []
            for start, end in _parts(texts):
                chunks, per_text = cut_chunks(texts[start:end], model.cut_lines)
                places = head.value.places(chunks)
                lost = np.concatenate([[0], np.cumsum(places < 0)])[np.concatenate([[0], np.cumsum(per_text)])]
                for text, ids, misses in zip(
                    texts[start:end], ids_of_texts(places, per_text, head.value), np.diff(lost), strict=True
                ):
                    if misses:
                        out.append((_digest(text), zlib.compress(text, 1), None, None, None))
                    else:
                        out.append((_digest(text), None, *_finished(rendering, text, ids)))
            yield _with_columns(batch, ["text"], out, [(key, pa.int64()), (packed, pa.binary()), *_RESULT])

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finish the packed texts with what the table has for them."""
        for batch in batches:
            out = list(zip(*(batch.column(name).to_pylist() for name, _ in _RESULT), strict=True))
            waiting = pc.indices_nonzero(batch.column(packed).is_valid()).to_pylist()
            texts = [zlib.decompress(text) for text in batch.column(packed).drop_null().to_pylist()]
            asked = batch.column(answers).take(pa.array(waiting, pa.int64())).to_pylist()
            for start, end in _parts(texts):
                chunks, per_text = cut_chunks(texts[start:end], model.cut_lines)
                places = head.value.places(chunks)
                lost = chunks.filter(pa.array(places < 0)).to_pylist()
                more = {chunk: ids for found in asked[start:end] for chunk, ids in _unpacked(found)}
                known, places = head.value.with_more(places, lost, more)
                found = ids_of_texts(places, per_text, known)
                for at, text, ids in zip(waiting[start:end], texts[start:end], found, strict=True):
                    out[at] = _finished(rendering, text, ids)
            yield _with_columns(batch, [key, packed, answers, *(name for name, _ in _RESULT)], out, _RESULT)

    others = [f"`{name}` {type_}" for name, type_ in docs.dtypes if name != "text"]
    result = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    middle = ", ".join([*others, f"`{key}` long", f"`{packed}` binary", *result])
    found = resolved.select(F.col("key").alias(key), F.col("answers").alias(answers))
    waiting = docs.mapInArrow(first_pass, middle).join(found, key, "left")
    return waiting.mapInArrow(second_pass, ", ".join([*others, *result]))


def _packed(answers: list[dict]) -> bytes:
    """Chunks and their ids, each after its length, compressed."""
    parts = [part for one in answers for part in (one["chunk"].encode("utf-8", "surrogatepass"), one["ids"])]
    lengths = np.array([len(parts), *map(len, parts)], dtype=np.uint32)
    return zlib.compress(lengths.tobytes() + b"".join(parts), 1)


def _unpacked(data: bytes) -> Iterator[tuple[str, bytes]]:
    data = zlib.decompress(data)
    n = int(np.frombuffer(data, dtype=np.uint32, count=1)[0])
    edges = 4 * (n + 1) + np.cumsum([0, *np.frombuffer(data, dtype=np.uint32, count=n, offset=4)])
    parts = [data[low:high] for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return zip((part.decode("utf-8", "surrogatepass") for part in parts[::2]), parts[1::2], strict=True)


def _resolved(docs: DataFrame, table: DataFrame, model: Model, head) -> DataFrame:
    """For texts with chunks beyond the head: ``key`` and ``answers``, these chunks' ids."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [marked(text) for text in batch.column(0).to_pylist()]
            for start, end in _parts(texts):
                chunks, per_text = cut_chunks(texts[start:end], model.cut_lines)
                lost = head.value.places(chunks) < 0
                if not lost.any():
                    continue
                owner = np.repeat(np.arange(end - start), per_text)[lost]
                keys = pa.array([_digest(text) for text in texts[start:end]], pa.int64())
                asked = pa.table({"key": keys.take(pa.array(owner)), "chunk": chunks.filter(pa.array(lost)).cast(pa.string())})
                yield from asked.group_by(["key", "chunk"]).aggregate([]).select(["key", "chunk"]).to_batches()

    # Equal texts ask as often as they occur, which is less than what puts a chunk into the head.
    asked = docs.select("text").mapInArrow(ask, "key long, chunk string")
    rest = table.filter((F.col("n") < head.value.least) | (F.octet_length("chunk") > HEAD_BYTES))
    answered = asked.join(rest.select("chunk", "ids"), "chunk")
    answers = answered.groupBy("key").agg(F.collect_set(F.struct("chunk", "ids")).alias("answers"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [_packed(found) for found in batch.column("answers").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(packed, pa.binary())], ["key", "answers"])

    return answers.mapInArrow(pack, "key long, answers binary")


def op12_chunk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
